import datetime as dt
import random

from martspark.functions.calendar import month_to_date
from martspark.operators.spine import keyed, spine_full_join_coalesced, spine_full_join_literal, spine_left_join

W = month_to_date(dt.date(1998, 2, 1))
DAYS = [dt.date(1998, 1, d) for d in (1, 2, 31)] + [dt.date(1998, 2, 1), None]


def _frames(spark, seed):
    rnd = random.Random(seed)
    dim = spark.createDataFrame(
        [(i, "ENTERPRISE" if i % 2 else "SME", f"r{i}") for i in range(1, 5)] + [(1, "ENTERPRISE", "dup")]
        if seed % 3 == 0 else [(i, "ENTERPRISE" if i % 2 else "SME", f"r{i}") for i in range(1, 5)],
        "restaurant_id long, classification_type_name string, restaurant_name string")

    def frame(name, n):
        rows = [(rnd.choice(DAYS), rnd.choice([1, 2, 3, 4, None]), rnd.randint(0, 9)) for _ in range(n)]
        return spark.createDataFrame(rows, f"d date, i long, {name} long")

    spine = keyed("a", frame("m_a", 12), "d", "i")
    branches = [keyed(p, frame(f"m_{p}", 10), "d", "i") for p in ("b", "c", "e")]
    return spine, dim, branches


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_literal_full_chain_equals_left_spine(spark):
    for seed in range(6):
        spine, dim, branches = _frames(spark, seed)
        cols = ["_d", "_id", "m_a", "m_b", "m_c", "m_e", "dim__restaurant_name"]
        left = _rows(spine_left_join(spine, dim, branches, W), cols)
        literal = _rows(spine_full_join_literal(spine, dim, branches, W), cols)
        assert left == literal, seed


def test_full_mode_keeps_branch_only_days(spark):
    spine = keyed("a", spark.createDataFrame([(dt.date(1998, 1, 1), 1, 5)], "d date, i long, m_a long"), "d", "i")
    b = keyed("b", spark.createDataFrame([(dt.date(1998, 1, 2), 1, 7)], "d date, i long, m_b long"), "d", "i")
    dim = spark.createDataFrame([(1, "ENTERPRISE")], "restaurant_id long, classification_type_name string")
    assert spine_left_join(spine, dim, [b], W).count() == 1
    got = _rows(spine_full_join_coalesced(spine, dim, [b], W), ["_d", "m_a", "m_b"])
    assert got == sorted([(dt.date(1998, 1, 1), 5, None), (dt.date(1998, 1, 2), None, 7)], key=str)


def test_full_mode_union_equals_full_join_chain(spark):
    from martspark.operators.spine import spine_full_join_chain
    rnd = random.Random(7)
    dim = spark.createDataFrame([(i, "ENTERPRISE" if i % 2 else "SME") for i in range(1, 6)],
                                "restaurant_id long, classification_type_name string")

    def unique_frame(name):
        keys = {(rnd.choice(DAYS[:4]), rnd.choice([1, 2, 3, 4, 5])) for _ in range(12)}
        rows = [(d, i, rnd.choice([None, rnd.randint(0, 9)])) for d, i in keys]
        return spark.createDataFrame(rows, f"d date, i long, {name} long")

    spine = keyed("a", unique_frame("m_a"), "d", "i")
    branches = [keyed(p, unique_frame(f"m_{p}"), "d", "i") for p in ("b", "c", "e")]
    cols = ["_d", "_id", "m_a", "m_b", "m_c", "m_e"]
    assert _rows(spine_full_join_coalesced(spine, dim, branches, W), cols) == \
        _rows(spine_full_join_chain(spine, dim, branches, W), cols)
