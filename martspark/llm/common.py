"""Shared helpers: scratch tables, word splitting, small-table joins."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a table that does not grow with the corpus is broadcast.
BROADCAST_ROWS = 200_000

#: ASCII bytes that separate words in `alnum_words`; A-Z are lower-cased first.
_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TO_SPACE = bytes(0x20 if b in _SEPARATORS else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of `spark.checkpoint.dir`; a local one only where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="llm-scratch-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for `df` if it has at most `limit` rows, else `df` as it is (shuffle join)."""
    return F.broadcast(df) if df.count() <= limit else df


def _named(docs: DataFrame, names: DataFrame, how: str) -> DataFrame:
    names = small(stored(names.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")), "names"))
    return docs.join(names, docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__hash")), how)


def without(docs: DataFrame, names: DataFrame) -> DataFrame:
    """The documents that `names` (doc_id, text_hash = xxhash64 of the text) doesn't name; all columns stay."""
    return _named(docs, names, "left_anti")


def picked(docs: DataFrame, names: DataFrame) -> DataFrame:
    """The documents that `names` names."""
    return _named(docs, names, "left_semi")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def alnum_words(text: bytes) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a UTF-8 text after lower-casing A-Z."""
    return text.lower().translate(_TO_SPACE).split()


def space_words(text: bytes) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of a UTF-8 text after lower-casing A-Z."""
    return text.lower().split()


U = np.uint64
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Masks of the first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], U)
_ODD = U(0x9E3779B97F4A7C15)
#: Text whose words are hashed together; longest word that is hashed eight bytes at a time.
HASHED_TEXT, HASHED_WORD = 1 << 20, 1024


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits, one to one."""
    x = x ^ (x >> U(33))
    for factor in (U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53)):
        x *= factor
        x ^= x >> U(33)
    return x


def _hashed(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, 64-bit hash) of the words of a text that starts and ends with nine spaces."""
    inside = ~_SPACE[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, size = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(text) - 7, "<u8", text, strides=1)  # the eight bytes from each place on
    h = mix((eight[starts] & _FIRST[np.minimum(size, 8)]) + size.astype(U) * _ODD)
    more, at = np.flatnonzero((size > 8) & (size <= HASHED_WORD)), 8
    while len(more):
        h[more] = mix(h[more] * _ODD + (eight[starts[more] + at] & _FIRST[np.minimum(size[more] - at, 8)]))
        at += 8
        more = more[size[more] > at]
    for i in np.flatnonzero(size > HASHED_WORD):
        h[i] = xxhash.xxh3_64_intdigest(text[starts[i]:starts[i] + size[i]])
    return starts, h


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, words of each text): the `space_words` of UTF-8 texts as 64-bit hashes, one text after the other."""
    size = np.array([len(t) + 1 for t in texts], np.int64)
    part = (np.cumsum(size) - size) // HASHED_TEXT
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    hashes, counts = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for a, b in zip(cuts, cuts[1:]):
        starts, h = _hashed(b" " * 9 + b" ".join(texts[a:b]).lower() + b" " * 9)
        hashes.append(h)
        counts.append(np.diff(np.searchsorted(starts, 9 + np.append(0, np.cumsum(size[a:b])))))
    return np.concatenate(hashes), np.concatenate(counts)


def as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8 bytes; null counts as empty."""
    values = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [v or b"" for v in values.to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of at most `rows` rows, so that what a task holds stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sized(batches: Iterable[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of about `size` bytes in a string column; a longer text is in a piece with others."""
    for batch in batches:
        part = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def tidy() -> None:
    """Give memory that a task no longer needs back to the system: Python workers live on for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; other systems have none
    if trim:
        trim(0)


def released(run: Callable) -> Callable:
    """A `mapInArrow` function that ends with `tidy`."""
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        tidy()
    return own


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = 512) -> Callable:
    """A `mapInArrow` function that applies `fn` to small slices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows):
            yield fn(batch)
    return run
