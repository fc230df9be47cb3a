"""Sharding by extendible hashing, in DataFrame operations.

The directory is indexed by the leading bits of a document's hash. A bucket
whose documents exceed the byte limit is split on one more bit, and only
that bucket; several directory entries may thus name one shard. The sizes of
all buckets down to STEP more bits come from one aggregation, so a round
settles STEP bits; a further round follows only for cells still too large.

After the bits of the id's hash come those of a hash of id and text, then of
a row number, so that equal ids, even equal rows, can be parted too. A single
document over the limit is a shard of its own.

Defined results: null and empty texts have 0 bytes; null ids hash like an
empty string. Repeated rows are sharded each on their own, null ids are kept,
an empty table has no shards. Extra columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martspark.llm.common import stored

#: Bits settled per round: the directory of a round's cells has 2**STEP entries per cell that it splits.
STEP = 16
#: Bits of each of the three hashes (of the id; of id and text; of the row).
HASH_BITS = 48


def hash_bits(key: Column, bits: int = HASH_BITS) -> Column:
    """The first `bits` bits of the MD5 of a string, as text of 0 and 1."""
    number = F.conv(F.substring(F.md5(key.cast("binary")), 1, bits // 4), 16, 10).cast("long")
    return F.lpad(F.bin(number), bits, "0")


def split_buckets(cells: DataFrame, limit: int) -> DataFrame:
    """(cell, shard, depth, shard_bytes, shard_docs, final) for cells of equal depth.

    Input: parent, cell (a bit string that starts with parent), bytes, docs. A cell's shard is its
    shortest prefix, from its parent on, whose bucket fits the limit or holds one document.
    """
    depth = F.sequence(F.length("parent"), F.length("cell"))
    steps = cells.withColumn("depth", F.explode(depth)).withColumn("prefix", F.expr("substring(cell, 1, depth)"))
    sums = steps.groupBy("parent", "depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
    fits = sums.where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1)).select("depth", "prefix", "shard_bytes", "shard_docs")
    best = (
        steps.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"])
        .groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_docs")).alias("b"))
    )
    return cells.join(best, "cell", "left").select(
        "cell", F.coalesce("b.prefix", "cell").alias("shard"), F.coalesce("b.shard_bytes", "bytes").alias("shard_bytes"),
        F.coalesce("b.shard_docs", "docs").alias("shard_docs"), F.col("b").isNotNull().alias("final"))


def assign(docs: DataFrame, limit: int, whole: bool = False) -> DataFrame:
    """doc_id, bytes, shard (hash prefix), depth, shard_bytes, shard_docs for every document. Input: doc_id, text.

    whole: each document's row comes along, as a struct `row`.
    """
    carried = ["row"] if whole else []
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    light = docs.select(
        *[F.struct(*docs.columns).alias(c) for c in carried], "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
        F.concat(hash_bits(key), hash_bits(F.concat_ws("\u0001", key, "text")), hash_bits(F.monotonically_increasing_id().cast("string"))).alias("bits"),
    )
    open_rows = stored(light.withColumn("parent", F.lit("")), "shard-rows")  # the row number is fixed from here on
    done = []
    for end in range(STEP, 3 * HASH_BITS + 1, STEP):
        rows = open_rows.withColumn("cell", F.substring("bits", 1, end))
        cells = stored(rows.groupBy("parent", "cell").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("docs")), "shard-cells")
        directory = stored(split_buckets(cells, limit), "shard-directory")
        placed = rows.join(directory, "cell")
        last = end == 3 * HASH_BITS
        done.append(placed.where(F.lit(last) | F.col("final")).select("doc_id", "bytes", "shard", F.length("shard").alias("depth"), "shard_bytes", "shard_docs", *carried))
        if last or directory.where("not final").isEmpty():
            break
        open_rows = stored(placed.where("not final").select(*carried, "doc_id", rows["bytes"], "bits", F.col("cell").alias("parent")), "shard-rows")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def write_shards(docs: DataFrame, limit: int, path: str) -> None:
    """Write all documents as Parquet, one folder `shard=<bits>` for each shard. Input: doc_id, text; repeated rows are written each on their own.

    Where the documents have a column `shard`, the folders' name gets underscores until it is free.
    """
    folder = "shard"
    while folder in docs.columns:
        folder += "_"
    rows = assign(docs, limit, whole=True).select("row.*", F.concat(F.lit("b"), "shard").alias(folder))
    # One shard fits one task; AQE joins small ones.
    rows.repartition(folder).write.partitionBy(folder).parquet(path)
