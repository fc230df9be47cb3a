import gzip
import hashlib
import json
import os

from martspark.llm import warc as W


def brute(rows, least=100):
    first, out = {}, []
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    seen = set()
    for i, _, html in rows:
        raw = (html or "").encode()
        again = i is not None and len(raw) >= least and (i != first[html or ""] or (i, html) in seen)
        seen.add((i, html))
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[html or ""] if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    long = "<p>ÀÉ漢\r\n\r\nWARC/1.1\r\n" * 40
    rows = [(i, f"http://h/{i}", long + str(i % 7)) for i in range(60)] + [(100, None, None), (101, "u\r\nWARC-Type: x", ""), (102, "u", "short"), (103, "u", "short"), (104, "u", "x" * 99), (105, "u", "x" * 99), (106, "u", "x" * 100), (107, "u", "x" * 100), (None, "u", long + "0"), (3, "again", long + "3"), (108, "u", "y" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' file", "1 seq").repartition(3)
    folder = f"file://{tmp_path}/warc"
    got = W.archive_pages(pages, folder=folder).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows)
    members = 0
    for name in os.listdir(tmp_path / "warc/archive"):
        if name.endswith(".warc.gz"):
            raw = (tmp_path / "warc/archive" / name).read_bytes()
            index = [json.loads(x) for x in (tmp_path / "warc/archive" / name.replace(".warc.gz", ".idx")).read_text().splitlines()]
            assert index[0][1] == 0 and index[-1][1] + index[-1][2] == len(raw)
            parts = [gzip.decompress(raw[o:o + n]) for _, o, n in index]
            assert gzip.decompress(raw) == b"".join(parts)  # a valid gzip file as a whole
            members += len(parts)
    assert members == len(rows)


def test_small_archives_and_empty_tables(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "z" * 500) for i in range(40)], "page_id long, url string, html string")
    manifest = W.write_monolithic(pages, f"file://{tmp_path}/m", archive_bytes=2000)
    manifest.write.parquet(f"{tmp_path}/manifest")
    manifest = spark.read.parquet(f"{tmp_path}/manifest")
    assert manifest.select("file").distinct().count() >= 10
    again = W.revisits(manifest)
    assert again.count() == 39 and {r.refers_to for r in again.collect()} == {0}
    assert W.archive_pages(pages.limit(0)).count() == 0


def test_cut_archives_are_errors(tmp_path):
    import io
    import pytest
    raw = W.record(1, "u", b"abc", "d", 3)
    assert list(W.records(W.gunzip(io.BytesIO(gzip.compress(raw * 2))))) == [raw, raw]
    assert list(W.records(iter([raw[:5], raw[5:] + raw]))) == [raw, raw]
    with pytest.raises(ValueError):
        list(W.records(iter([raw[:-10]])))
