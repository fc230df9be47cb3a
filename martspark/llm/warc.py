"""WARC archives: write whole-file gzip streams, normalise them record by record, read back.

`write_monolithic` writes each partition's pages as archives that are one
gzip stream each. `normalise` inflates such a stream once, writes every
record as a gzip member of its own and a sidecar index (offset and length of
each member), and turns repeated payloads into revisit records.
`read_archives` seeks to the members that the sidecars list and parses them.

Files go to a folder on a file system that all executors share. Every
attempt of a task writes files of its own name; only files named in the
manifest that Spark returns count, so a lost executor's files are ignored.

Defined results: a null payload is empty; a null url is an empty header.
Rows with a null page_id are written as responses and come back with a null
id. Of repeated rows with one page_id and payload, one is the response.
An empty table writes no archive.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martspark.llm.common import as_bytes, scratch_path, slices, stored

#: Uncompressed bytes after which a task starts its next archive.
ARCHIVE_BYTES = 32 << 20
CHUNK = 1 << 18
MANIFEST = "file string, seq long, page_id long, payload_bytes long, payload_digest string"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, offset long, length long, file string, url string"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def record(page_id: int | None, url: str, payload: bytes, digest: str, size: int, refers_to: int | None = None) -> bytes:
    """One record: a response with its payload, or a revisit with the headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {' '.join(url.split())}", "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = http + (payload if refers_to is None else b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], int | None, bytes]:
    """(headers, payload size by the HTTP header, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
    http, _, payload = rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    size = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    return headers, size, payload


def page_of(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def gunzip(source, chunk: int = CHUNK) -> Iterator[bytes]:
    """Inflate a gzip file of one or many members, a chunk at a time."""
    inflate = zlib.decompressobj(31)
    while data := source.read(chunk):
        while data:
            yield inflate.decompress(data)
            data = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(31)


def records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Cut an inflated stream into records by their Content-Length; holds one record at a time."""
    held = bytearray()

    def fill(n: int) -> bool:
        while len(held) < n:
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not fill(len(held) + 1):
                if held.strip():
                    raise ValueError("archive ends within a record's head")
                return
        head = bytes(held[:end])
        length = next(int(x.split(b":", 1)[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        whole = end + 4 + length + 4
        if not fill(whole):
            raise ValueError("archive ends within a record")
        yield bytes(held[:whole])
        del held[:whole]


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(schema), schema.types)], schema=schema)


_ARROW = {"long": pa.int64(), "string": pa.string()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (x.split() for x in ddl.split(", "))])


def write_monolithic(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write page_id, url, html as monolithic archives; returns the manifest (lazy: store it once)."""
    schema = _schema(MANIFEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        sink, name, squeeze, size, seq, rows = None, "", None, 0, 0, []
        for batch in slices(batches):
            ids, urls, payloads = batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2))
            for page_id, url, payload in zip(ids, urls, payloads):
                if sink is None:
                    name, squeeze, size, seq = f"{uuid.uuid4().hex}.warc.gz", zlib.compressobj(1, zlib.DEFLATED, 31), 0, 0
                    sink = fs.open_output_stream(f"{root}/{name}", compression=None)
                digest = hashlib.sha256(payload).hexdigest()
                raw = record(page_id, url or "", payload, digest, len(payload))
                sink.write(squeeze.compress(raw))
                rows.append((name, seq, page_id, len(payload), digest))
                size, seq = size + len(raw), seq + 1
                if size >= archive_bytes:
                    sink.write(squeeze.flush())
                    sink.close()
                    sink = None
            if rows:
                yield _rows(rows, schema)
                rows = []
        if sink is not None:
            sink.write(squeeze.flush())
            sink.close()

    return pages.select("page_id", "url", "html").mapInArrow(run, MANIFEST)


def revisits(manifest: DataFrame, least_bytes: int = 100) -> DataFrame:
    """file, seq, refers_to of every record whose payload an earlier page_id (then file, seq) has."""
    alike = manifest.where((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
    first = (
        alike.groupBy("payload_digest")
        .agg(F.min(F.struct("page_id", "file", "seq")).alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("payload_digest", "first")
    )
    return alike.join(first, "payload_digest").where(
        (F.col("file") != F.col("first.file")) | (F.col("seq") != F.col("first.seq"))
    ).select("file", "seq", F.col("first.page_id").alias("refers_to"))


def normalise(manifest: DataFrame, again: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite every archive of the manifest, one task a file; returns file, records (lazy: store it once)."""
    schema = pa.schema([("file", pa.string()), ("records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (fs, src), (out, dst) = file_system(source), file_system(target)
        out.create_dir(dst, recursive=True)
        for batch in batches:
            for name, seqs, refers in zip(*(batch.column(i).to_pylist() for i in range(3))):
                refer, made = dict(zip(seqs or (), refers or ())), uuid.uuid4().hex
                offset, n = 0, 0
                with fs.open_input_stream(f"{src}/{name}", compression=None) as stream, \
                        out.open_output_stream(f"{dst}/{made}.warc.gz", compression=None) as sink, \
                        out.open_output_stream(f"{dst}/{made}.idx", compression=None) as index:
                    for seq, raw in enumerate(records(gunzip(stream))):
                        headers, size, payload = parse(raw)
                        page_id = page_of(headers["WARC-Record-ID"])
                        if seq in refer:
                            raw = record(page_id, headers["WARC-Target-URI"], payload, headers["WARC-Payload-Digest"][7:], size, refer[seq])
                        squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = squeeze.compress(raw) + squeeze.flush()
                        sink.write(member)
                        index.write(json.dumps([page_id, offset, len(member)]).encode() + b"\n")
                        offset, n = offset + len(member), n + 1
                yield _rows([(made, n)], schema)

    plans = again.groupBy("file").agg(F.collect_list(F.struct("seq", "refers_to")).alias("r"))  # of one archive: bounded by its size
    names = manifest.select("file").distinct()
    files = names.join(plans, "file", "left").repartition(max(1, names.count()), "file")
    return files.select("file", F.col("r.seq").alias("seqs"), F.col("r.refers_to").alias("refers")).mapInArrow(run, "file string, records long")


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """One row per record of normalised archives, read member by member through the sidecar index."""
    schema = _schema(RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with fs.open_input_stream(f"{root}/{name}.idx", compression=None) as index:
                    wanted = [json.loads(x) for x in index.read().splitlines()]
                with fs.open_input_file(f"{root}/{name}.warc.gz") as archive:
                    for _, offset, length in wanted:
                        archive.seek(offset)
                        headers, size, payload = parse(zlib.decompress(archive.read(length), 31))
                        kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"][7:]
                        if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                            raise ValueError(f"{name} at {offset}: payload and digest differ")
                        refers = page_of(headers["WARC-Refers-To"]) if kind == "revisit" else None
                        rows.append((page_of(headers["WARC-Record-ID"]), size, digest, kind, refers, offset, length, name, headers.get("WARC-Target-URI", "")))
                        if len(rows) == 4096:
                            yield _rows(rows, schema)
                            rows = []
                yield _rows(rows, schema)

    return files.select("file").mapInArrow(run, RECORD)


def archive_pages(pages: DataFrame, least_bytes: int = 100, folder: str | None = None) -> DataFrame:
    """Write, normalise and read back all pages; returns the records read."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    manifest = stored(write_monolithic(pages, f"{folder}/monolithic"), "warc-manifest")
    files = stored(normalise(manifest, revisits(manifest, least_bytes), f"{folder}/monolithic", f"{folder}/archive"), "warc-files")
    n = files.count()
    return read_archives(files.repartition(max(1, n)), f"{folder}/archive")
