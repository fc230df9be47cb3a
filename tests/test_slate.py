"""Slate queries against the DuckDB oracle, plan checks and the entry point."""

import math
import os
import re
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from paths import ROOT, SF_ORACLE, SF_SMALL
from martspark.plans import slate as S

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return con


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):  # exact: money leaves as DOUBLE of an exact decimal in both engines
        return str(v) if isinstance(v, float) and not math.isfinite(v) else v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda t: tuple(map(str, t)))


SLATE = list(S.QUERIES)


@pytest.mark.parametrize("name", SLATE)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_ORACLE)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(res.fetchall(), dcols)


def test_every_query_has_an_oracle():
    assert set(SLATE) <= set(E.queries()) and set(SLATE) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_is_the_kpi_mart(spark):
    df = E.entry(spark)
    assert len(df.columns) == 83
    assert df.count() >= 0


@pytest.mark.parametrize("name", ["kpi_monthly", "promo_daily", "month_rollup", "multi_distinct_rollup"])
def test_plans_stay_jvm_side_and_pushed(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # the window range on the bookings' instants reaches the orders scan
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate,1997-12-31T17:00\)", plan)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["kpi_monthly", "daily_economics", "sum_distinct_vs_order_distinct"])
def test_economics_have_no_expand(spark, name):
    assert "Expand" not in _plan(E.queries()[name](spark, SF_SMALL))


def test_as_of_filter_reaches_the_history_scan(spark, tmp_path):
    """On history tables the effective bound is a pushed filter."""
    from martspark.operators import history as H
    from martspark.sources.tpch import tpch_sources
    src = tpch_sources(spark, SF_SMALL)
    for name in ("dim_outlet", "dim_account"):
        getattr(src, name).write.parquet(f"{tmp_path}/{name}")
    outlet, account = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("dim_outlet", "dim_account"))
    want = r"PushedFilters: \[[^\]]*LessThan\(effective_timestamp,1998-01-31T17:00\)"
    prev = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # plans show the filters whole
    try:
        assert re.search(want, _plan(H.outlets_as_of(outlet, S.WINDOW.end)))
        assert len(re.findall(want, _plan(H.outlet_bridge(outlet, account, S.WINDOW.end)))) >= 3
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", prev)


def test_nothing_stays_cached_and_no_one_task_limit(spark):
    spark.catalog.clearCache()
    for name in ("kpi_monthly", "promo_daily"):
        df = E.queries()[name](spark, SF_SMALL)
        assert "GlobalLimit" not in _plan(df)
        df.collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_fx_table_with_two_rates_a_year_is_refused(spark):
    from martspark.operators.quality import FanOutError
    from martspark.plans import marts as M
    src = S._src(spark, SF_SMALL)
    src._built["fx"] = spark.createDataFrame([(1998, 1.0), (1998, 2.0)], "year int, rate double")
    with pytest.raises(FanOutError, match="FX relation"):
        M.kpi_monthly(src, S.RUN_DATE)
    from martspark.functions.money import with_rate
    from martspark.operators import branches as B
    good = S._src(spark, SF_SMALL)
    ent = S._ent(good)
    known, unknown = B.economics_parts(good.bookings, good.booking_cm, S.WINDOW, ent)
    orders = B.order_economics_fused(known, unknown, good.fx)
    for use in (lambda: B.daily_economics(orders, src.fx), lambda: B.order_distinct_sum(orders, src.fx), lambda: B.cost_split(known, src.fx),
                lambda: B.order_economics_fused(known, unknown, src.fx), lambda: with_rate(good.booking_cm, "booking_date", src.fx)):
        with pytest.raises(FanOutError, match="FX relation"):
            use()


def test_queries_run_without_a_checkpoint_folder(tmp_path):
    """A session whose configuration names no shared folder."""
    code = ("import sys; sys.path.insert(0, sys.argv[1]); from pyspark.sql import SparkSession; "
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate(); "
            "from martspark.plans.slate import QUERIES as q; "
            "assert s.conf.get('spark.checkpoint.dir', None) is None; "
            f"print('rows', q['restaurant_dim'](s, '{SF_SMALL}').count(), q['refresh_append'](s, '{SF_SMALL}').count())")
    empty = tmp_path / "conf"
    empty.mkdir()
    env = os.environ | {"SPARK_CONF_DIR": str(empty)}
    done = subprocess.run([sys.executable, "-c", code, ROOT], capture_output=True, text=True, timeout=300, env=env, cwd=tmp_path)
    assert re.search(r"rows [1-9]\d* [1-9]\d*", done.stdout), done.stderr[-1500:]


@pytest.mark.parametrize("name, windows", [("daily_economics", 1), ("sum_distinct_vs_order_distinct", 1), ("multi_distinct_rollup", 0)])
def test_distincts_need_no_window_but_the_per_booking_one(spark, name, windows):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "Expand" not in plan
    kinds = set(re.findall(r"Window \[[^\n]*\], \[(order_no#\d+, booking_date#\d+)\]", plan))
    assert len(re.findall(r"\bWindow \[", plan)) == len(re.findall(r"\bWindow \[[^\n]*\], \[order_no#\d+, booking_date#\d+\]", plan))
    assert (len(kinds) > 0) == bool(windows)


def test_building_the_promo_mart_starts_no_job(spark):
    from martspark.plans import marts as M
    src = S._src(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("promo-build", "none expected")
    try:
        M.promo_daily(src, S.RUN_DATE, tiers=S.DRIVER_TIERS)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("promo-build")) == 0
    finally:
        spark.sparkContext.setJobGroup("tests", "")


def test_promo_mart_has_no_expand(spark):
    plan = E.queries()["promo_daily"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


@pytest.mark.parametrize("name", ["local_date_window", "local_datetime_window_cutoff", "history_as_of",
                                  "weighted_rating", "promo_daily"])
def test_results_do_not_depend_on_session_zone_or_ansi(spark, duck, name):
    keys = {"spark.sql.session.timeZone": "America/Los_Angeles", "spark.sql.ansi.enabled": "false"}
    prev = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = E.queries()[name](spark, SF_ORACLE)
        rows = [tuple(r) for r in df.collect()]
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
    res = duck.execute(E.oracle_sql()[name])
    assert _canon(rows, df.columns) == _canon(res.fetchall(), [d[0] for d in res.description])


def test_pre_grouped_promo_mart_equals_the_one_aggregate_form(spark):
    from martspark.plans import marts as M
    from martspark.plans.slate import DRIVER_TIERS, _src
    from martspark.sources.tpch import RUN_DATE
    s = _src(spark, SF_SMALL)
    a = M.promo_daily(s, RUN_DATE, tiers=DRIVER_TIERS)
    b = M.promo_daily_direct(s, RUN_DATE, tiers=DRIVER_TIERS)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0
