import datetime as dt

import pytest

from martspark.functions.money import fx_table, with_rate
from martspark.operators import history as H
from martspark.operators.quality import FanOutError, assert_unique, duplicate_keys
from martspark.sources import schemas as S

AS_OF = dt.date(1998, 1, 31)


def _ts(s):
    return dt.datetime.fromisoformat(s) if s else None


def test_as_of_and_null_flags(spark):
    rows = [
        # sf_outlet_id, outlet_id, account, eff, exp, deleted, duplicate
        ("a", 1, "E1", "1998-01-01 00:00:00", None, False, None),        # open, kept
        ("b", 2, "E2", "1998-01-01 00:00:00", "1998-01-31 16:59:59", False, False),  # expires on d local
        ("c", 3, "E3", "1998-01-01 00:00:00", "1998-01-31 17:00:00", False, False),  # expires next local day
        ("d", 4, "E4", "1998-01-31 17:00:00", None, False, False),       # starts next local day
        ("e", 5, "E5", "1998-01-01 00:00:00", None, None, False),        # NULL deleted: dropped (C16)
        ("f", 6, "E6", "1998-01-01 00:00:00", None, True, False),        # deleted
        ("g", 7, "E7", "1998-01-01 00:00:00", None, False, True),        # duplicate
    ]
    rows = [(a, b, c, _ts(d), _ts(e), f, g) for a, b, c, d, e, f, g in rows]
    df = spark.createDataFrame(rows, S.DIM_OUTLET)
    got = sorted(r["sf_outlet_id"] for r in H.outlets_as_of(df, AS_OF).collect())
    assert got == ["a", "c"]


def test_soft_delete_rules_differ_on_null(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(True,), (False,), (None,)], "deleted_flag boolean")
    strict = df.where(H.not_deleted_strict()).count()
    lenient = df.where(H.not_flagged("deleted_flag")).count()
    assert (strict, lenient) == (1, 2)
    assert df.where(F.col("deleted_flag").eqNullSafe(True)).count() == 1


def test_fx_table_rejects_two_rates_for_a_year(spark):
    with pytest.raises(ValueError, match="2024"):
        fx_table(spark, [(2024, 16000), (2024, 15000), (2023, 15700)])


def test_fx_join_does_not_fan_out(spark):
    fx = fx_table(spark, {2023: 15700, 2024: 16000})
    df = spark.createDataFrame([(dt.date(2024, 5, 1), 1.0), (dt.date(2022, 1, 1), 2.0)], "d date, x double")
    rows = sorted(with_rate(df, "d", fx).collect(), key=lambda r: r["d"])
    assert len(rows) == 2 and rows[0]["rate"] is None and float(rows[1]["rate"]) == 16000.0


def test_assert_unique_names_offending_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    with pytest.raises(FanOutError, match=r"\(1,\) x2"):
        assert_unique(df, ["k"], "dim")
    assert [tuple(r) for r in duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    assert assert_unique(df.where("k = 2"), ["k"]) is not None


def test_lookups_beyond_the_bound_use_shuffle_joins(spark):
    from pyspark.sql import functions as F
    from martspark.operators.dims import Enterprise
    from martspark.plans.joins import lookup_side
    dim = spark.createDataFrame([(i, f"uuid-{i}", "ENTERPRISE" if i % 3 else "SME") for i in range(30)],
                                "restaurant_id long, restaurant_uuid string, classification_type_name string")
    facts = spark.range(300).select((F.col("id") % 40).alias("restaurant_id"),
                                    F.concat(F.lit("uuid-"), F.col("id") % 40).alias("restaurant_uuid"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = Enterprise.of(dim, max_broadcast_rows=0)
        small = Enterprise.of(dim)
        for how in ("restrict", "by_uuid"):
            a = sorted(map(tuple, getattr(big, how)(facts).collect()))
            b = sorted(map(tuple, getattr(small, how)(facts).collect()))
            assert a == b and len(a) == 153
        plan = big.restrict(facts)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        plan = lookup_side(dim, max_rows=5).join(facts, "restaurant_id")._jdf.queryExecution() \
            .executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_distinct_rollup_equals_count_distinct(spark):
    import random

    from pyspark.sql import functions as F

    from martspark.operators.distinct import distinct_rollup
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(["o1", "o2", "o3", None]), rnd.choice(["c1", "c2", None]),
             rnd.choice(["3", "1", None]), rnd.choice([None, 1.0, 2.5, 4.0])) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, order_no string, customer string, status string, amt double")
    done = F.col("status") == "3"
    big = F.col("amt") > 2
    got = distinct_rollup(df, ["k"], "order_no",
                          unit_counts={"trx": done, "total": None, "big": done & big},
                          sums={"s": F.when(done, F.col("amt"))},
                          other_distinct={"mau": F.when(done, F.col("customer"))})
    want = df.groupBy("k").agg(
        F.count_distinct(F.when(done, F.col("order_no"))).alias("trx"),
        F.count_distinct("order_no").alias("total"),
        F.count_distinct(F.when(done & big, F.col("order_no"))).alias("big"),
        F.sum(F.when(done, F.col("amt"))).alias("s"),
        F.count_distinct(F.when(done, F.col("customer"))).alias("mau"))
    key = lambda r: str(r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.select(got.columns).collect()), key=key)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
