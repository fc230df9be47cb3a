import numpy as np
from pyspark.sql import functions as F

from martspark.llm import topk


def brute(vectors, k, scale):
    whole = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.setdefault(i, []).append([int(np.floor(scale * np.float64(np.float32(x)))) for x in v])
    out = set()
    for q in whole:
        if q % 10 == 0:
            asks = min(whole[q])
            scores = sorted((-sum(a * b for a, b in zip(asks, v)), i) for i, vs in whole.items() if i != q for v in vs)
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return out


def test_against_brute_force(spark, monkeypatch):
    pick = np.random.default_rng(3)
    vectors = [(i, [float(x) if pick.random() < 0.7 else 0.0 for x in pick.standard_normal(pick.integers(1, 9))]) for i in range(300)]
    vectors += [(i, [1.0, 1.0, 1.0]) for i in range(300, 360)]  # ties
    vectors += [(400, None), (401, [None, 1.0]), (402, [float("nan")]), (403, [float("inf"), 1.0]), (410, []), (None, [1.0]), (20, [5.0, 5.0]), (20, [5.0, 5.0]), (21, [3.0]), (21, [3.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").selectExpr("*", "1 terms", "2 qb", "'x' side")
    for blocks in ((1024, 8192), (7, 50)):
        monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
        monkeypatch.setattr(topk, "CANDIDATE_BLOCK", blocks[1])
        got = {(r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, 5, 1024).collect()}
        assert got == brute(vectors, 5, 1024)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0, 5).count() == 0
    few = {(r.query_id, r.vec_id) for r in topk.top_k(df.where("vec_id in (10, 11, 12)"), F.col("vec_id") == 10, 5).collect()}
    assert few == {(10, 11), (10, 12)}


def test_best_breaks_ties_by_id():
    scores, ids = np.array([5, 7, 7, 7, 1]), np.array([9, 8, 3, 4, 1])
    assert list(ids[topk.best(scores, ids, 2)]) == [3, 4] and list(ids[topk.best(scores, ids, 9)]) == [3, 4, 8, 9, 1]


def test_a_hot_id_is_spread_over_the_blocks(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 9, id) vec_id", "array(1L) terms")
    cells = topk.dealt(rows, 10, 2).groupBy("qb", "cb").agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") == 9).alias("hot")).collect()
    assert len(cells) == 20 and sum(r.n for r in cells) == 6000 and sum(r.hot for r in cells) == 2000
    assert max(r.n for r in cells) < 400 and max(r.hot for r in cells) < 160
