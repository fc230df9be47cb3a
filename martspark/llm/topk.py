"""Exact top-k by exhaustive term-at-a-time scoring.

Queries and candidates meet in a grid of (query block, candidate block)
cells. In a cell the query block's weights are scattered, one term after the
other, over that term's postings into a dense score array; the k best of
each cell are selected by partition and merged per query. Nothing is
broadcast, and a task holds one query block and one slice of candidates.

Defined results: vectors that are null, or hold a null or non-finite
component, take no part; a component past a vector's end counts as 0; rows
with a null id take no part. Ties go to the smaller id. Repeated ids are separate
candidates; as a query an id counts once (its smallest vector), and rows with
the query's id never answer it. Scores are 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 8192


def integer_terms(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as longs; null if any is null or not finite."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), whole)


def _dense(column: pa.Array) -> np.ndarray:
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *map(len, column)])
    width = np.diff(ends)
    out = np.zeros((len(width), int(width.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(width)), width), np.concatenate([np.arange(w) for w in width]) if len(width) else []] = flat
    return out


def scatter_scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """scores[q, row], one term at a time over the postings of that term."""
    scores = np.zeros((len(queries), len(rows)), np.int64)
    for term in range(min(queries.shape[1], rows.shape[1])):
        asked, posting = np.flatnonzero(queries[:, term]), np.flatnonzero(rows[:, term])
        weights, values = queries[asked, term], rows[posting, term]
        if len(asked) == len(queries) and len(posting) == len(rows):
            scores += weights[:, None] * values
        elif len(asked) and len(posting):
            scores[np.ix_(asked, posting)] += weights[:, None] * values
    return scores


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        held = np.flatnonzero(scores >= least)
    else:
        held = np.arange(len(scores))
    return held[np.lexsort((ids[held], -scores[held]))][:k]


def _cells(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, queries, parts = None, None, None, []
        top: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def flush():
            rows = [(np.full(len(s), ids[q]), v, s) for q, (v, s) in top.items()]
            cols = [np.concatenate(x) if rows else np.zeros(0, np.int64) for x in (zip(*rows) if rows else ((), (), ()))]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=schema)

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)  # query block, candidate block, side
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part, vec, side = batch.slice(a, b - a), batch.column(3).slice(a, b - a).to_numpy(), keys[a, 2]
                if cell != (keys[a, 0], keys[a, 1]):
                    if top:
                        yield flush()
                    cell, ids, queries, parts, top = (keys[a, 0], keys[a, 1]), None, None, [], {}
                if side == 0:
                    parts.append((vec, _dense(part.column(4))))
                    continue
                if parts:  # all queries of the cell come before its candidates
                    width = max(m.shape[1] for _, m in parts)
                    ids = np.concatenate([v for v, _ in parts])
                    queries = np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for _, m in parts])
                    parts = []
                if ids is None:
                    continue
                for at in range(0, b - a, 4096):
                    rows, own = _dense(part.column(4).slice(at, 4096)), vec[at:at + 4096]
                    for q, scores in enumerate(scatter_scores(queries, rows)):
                        other = own != ids[q]
                        v, s = own[other], scores[other]
                        pick = best(s, v, k)
                        v, s = v[pick], s[pick]
                        if q in top:
                            v, s = np.concatenate([top[q][0], v]), np.concatenate([top[q][1], s])
                            pick = best(s, v, k)
                            v, s = v[pick], s[pick]
                        top[q] = (v, s)
        if top:
            yield flush()
    return run


def dealt(rows: DataFrame, blocks: int, query_blocks: int) -> DataFrame:
    """Every row once for each query block, in a candidate block by id and row, so that a hot id is spread. Input: vec_id, terms."""
    return (
        rows.select("vec_id", "terms", F.monotonically_increasing_id().alias("row"))
        .select("vec_id", "terms", F.pmod(F.xxhash64(F.lit(2), "vec_id", "row"), F.lit(blocks)).cast("int").alias("cb"))
        .select(F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"), "cb", F.lit(1).alias("side"), "vec_id", "terms")
    )


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score for every row that `is_query` selects, against all rows. Input: vec_id, embedding."""
    rows = (
        vectors.select("vec_id", integer_terms(F.col("embedding"), scale).alias("terms"), is_query.alias("asks"))
        .where("terms is not null and vec_id is not null")
    )
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    blocks, query_blocks = max(1, -(-n // CANDIDATE_BLOCK)), max(1, -(-asked // QUERY_BLOCK))
    asking = rows.where("asks").groupBy("vec_id").agg(F.min("terms").alias("terms"))
    queries = asking.select(
        F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(query_blocks)).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("cb"), F.lit(0).alias("side"), "vec_id", "terms")
    cells = queries.unionByName(dealt(rows, blocks, query_blocks)).repartition("qb", "cb").sortWithinPartitions("qb", "cb", "side", "vec_id")
    found = cells.mapInArrow(_cells(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
