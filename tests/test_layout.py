"""Inputs stored for the marts: what the plans over them read and shuffle."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from paths import SF_SMALL
from pyspark.sql import functions as F

from martspark.functions.calendar import MonthWindow
from martspark.operators import branches as B
from martspark.operators import history as H
from martspark.operators.dims import Enterprise, restaurant_dim
from martspark.plans import jobs
from martspark.plans import marts as M
from martspark.plans.slate import DRIVER_TIERS, WINDOW
from martspark.sources import layout as L
from martspark.sources import schemas as S
from martspark.sources.catalog import LazySources
from martspark.sources.tpch import FX_RATES, RUN_DATE, tpch_sources


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_rows(df, table):
    """Rows that the scan of a table gave, after the run."""
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec" and table in node.toString():
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
    walk(plan)
    return sum(found)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """All mart inputs written in their layouts, and read back."""
    base = tmp_path_factory.mktemp("layout")
    src = tpch_sources(spark, SF_SMALL)
    jobs.write_bookings(spark, src.bookings, "l_bookings", 4, path=f"{base}/bookings")
    jobs.write_economics(spark, src.booking_cm, "l_economics", 4, path=f"{base}/economics")
    L.write_promo_tx(src.promo_tx, f"{base}/promo_tx")
    for name in ("dim_outlet", "dim_account"):
        L.write_history(getattr(src, name), f"{base}/{name}")
    for name in LazySources.NAMES:
        if name not in ("fx", "econ_bookings", "bookings", "booking_cm", "promo_tx", "dim_outlet", "dim_account"):
            getattr(src, name).write.parquet(f"{base}/{name}")
    yield jobs.table_sources(spark, str(base), FX_RATES, tables={"bookings": "l_bookings", "booking_cm": "l_economics"})
    for table in ("l_bookings", "l_economics"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


@pytest.fixture
def no_broadcast(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stored_inputs_give_the_same_marts(spark, stored):
    src = tpch_sources(spark, SF_SMALL)
    assert _rows(M.kpi_monthly(stored, RUN_DATE, prune=True)) == _rows(M.kpi_monthly(src, RUN_DATE))
    assert _rows(M.promo_daily(stored, RUN_DATE, tiers=DRIVER_TIERS)) == _rows(M.promo_daily(src, RUN_DATE, tiers=DRIVER_TIERS))


def test_the_kpi_mart_moves_neither_bookings_nor_economics(spark, stored, no_broadcast):
    mart = M.kpi_monthly(stored, RUN_DATE)
    plan = plan_of(mart)
    assert "l_economics" in plan and "Bucketed: true" in plan and "SortMergeJoin [order_no" in plan
    assert not re.search(r"Exchange hashpartitioning\((_cm_order|order_no)#\d+, \d+\)", plan)
    # The same mart over plain files shuffles both.
    plain = plan_of(M.kpi_monthly(tpch_sources(spark, SF_SMALL), RUN_DATE))
    assert re.search(r"Exchange hashpartitioning\(_cm_order#\d+, \d+\)", plain)


def test_months_of_bookings_are_partitions(spark, stored):
    for df in (B.bookings_in_window(stored.bookings, WINDOW), M.promo_rows(stored, RUN_DATE)):
        assert re.search(r"PartitionFilters: \[[^\]]*created_local_date", plan_of(df))
    tx = stored.promo_tx.where(WINDOW.contains(F.col("jakarta_booking_date")))
    assert re.search(r"PartitionFilters: \[[^\]]*jakarta_booking_date", plan_of(tx))


@pytest.mark.parametrize("tz", ["Asia/Jakarta", "America/Los_Angeles", "Pacific/Kiritimati", "Etc/GMT+12"])
def test_both_ends_of_the_month_stay_in_any_zone(spark, stored, tz):
    """Bookings stored by Jakarta's dates, read by another zone's month."""
    plain = tpch_sources(spark, SF_SMALL).bookings
    got = _rows(B.bookings_in_window(stored.bookings, WINDOW, tz).select("order_no", "created_timestamp"))
    assert got == _rows(B.bookings_in_window(plain, WINDOW, tz).select("order_no", "created_timestamp")) and got


def test_rows_at_the_ends_of_the_month(spark, tmp_path):
    at = ["1997-12-31 16:59:59", "1997-12-31 17:00:00", "1998-01-31 16:59:59", "1998-01-31 17:00:00", "1998-01-01 07:59:59", "1998-01-01 08:00:00", "1998-02-01 07:59:59",
          "1998-02-01 08:00:00", None]
    df = spark.createDataFrame([(f"o{i}" if i % 4 else None, t) for i, t in enumerate(at)], "order_no string, t string").select(
        "order_no", F.col("t").cast("timestamp_ntz").alias("created_timestamp"))
    try:
        L.write_bookings(df, "l_ends", 2, path=str(tmp_path / "ends"))
        table = spark.table("l_ends")
        assert table.count() == len(at)
        month = MonthWindow(dt.date(1998, 1, 1), dt.date(1998, 1, 31))
        for tz, n in (("Asia/Jakarta", 4), ("America/Los_Angeles", 4)):
            read = B.bookings_in_window(table, month, tz)
            assert read.count() == B.bookings_in_window(df, month, tz).count() == n
            assert "PartitionFilters: [isnotnull(created_local_date" in plan_of(read)
    finally:
        spark.sql("DROP TABLE IF EXISTS l_ends")


def test_economics_are_skipped_by_order_number(spark, tmp_path, no_broadcast):
    """Only row groups whose order numbers can be the month's are read; Parquet's Bloom filter answers for one order."""
    n = 40_000
    bookings = spark.range(n).selectExpr(
        "format_string('o%08d', id) order_no", "1 + id % 2 restaurant_id", "cast(null as string) Food_mode_name",
        f"cast(if(id < {n // 40}, timestamp'1998-01-10 00:00:00', timestamp'1997-06-01 00:00:00') as timestamp_ntz) created_timestamp")
    bookings = bookings.withColumn("rpl_detail_list", F.lit(None).cast(S.BOOKINGS["rpl_detail_list"].dataType))
    cm = spark.range(n).selectExpr("format_string('o%08d', id) order_no", "date'1998-01-10' booking_date", *[f"cast(1 as decimal(18,4)) {c}" for c in S.ECONOMICS_AMOUNTS])
    dim = spark.createDataFrame([(1, "u1", "ENTERPRISE"), (2, "u2", "ENTERPRISE")], "restaurant_id long, restaurant_uuid string, classification_type_name string")
    prev = spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.enabled")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")
    small = {"parquet.block.size": "16384", "parquet.block.size.row.check.min": "100"}  # many row groups
    for key, value in small.items():
        spark._jsc.hadoopConfiguration().set(key, value)
    try:
        L.write_bookings(bookings, "l_many_bookings", 4, path=str(tmp_path / "b"))
        L.write_economics(cm, "l_many_economics", 4, path=str(tmp_path / "e"))
        read = {}
        for prune in (False, True):
            known, _ = B.economics_parts(spark.table("l_many_bookings"), spark.table("l_many_economics"), WINDOW, Enterprise.of(dim), prune=prune)
            rows = known.where("cm_amount > 0").select("order_no", "cm_amount")
            assert len(rows.collect()) == n // 40
            read[prune] = scanned_rows(rows, "l_many_economics")
        assert read[False] == n and read[True] < n // 2, read
        absent = spark.table("l_many_economics").where("order_no = 'o00000001x'")
        assert absent.collect() == [] and scanned_rows(absent, "l_many_economics") == 0
    finally:
        spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", prev)
        for key in small:
            spark._jsc.hadoopConfiguration().unset(key)
        for table in ("l_many_bookings", "l_many_economics"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_rows_without_an_order_number_spread(spark, tmp_path):
    """A third of the bookings without a number: no join task holds them, and the writer deals them out."""
    df = spark.range(3000).selectExpr("if(id % 3 = 0, null, concat('o', id)) order_no", "id restaurant_id", "timestamp_ntz'1998-01-10 00:00:00' created_timestamp",
                                      "'FOOD-DELIVERY' Food_mode_name").withColumn("rpl_detail_list", F.lit(None).cast(S.BOOKINGS["rpl_detail_list"].dataType))
    try:
        L.write_bookings(df, "l_nulls", 4, path=str(tmp_path / "n"))
        table = spark.table("l_nulls")
        assert table.count() == 3000
        files = table.where("order_no is null").select(F.input_file_name().alias("f")).distinct().count()
        assert files > 4
    finally:
        spark.sql("DROP TABLE IF EXISTS l_nulls")
    cm = spark.createDataFrame([("o1", dt.date(1998, 1, 10), *[Decimal(1)] * len(S.ECONOMICS_AMOUNTS))], S.BOOKING_CM)
    dim = df.selectExpr("restaurant_id", "string(restaurant_id) restaurant_uuid", "'ENTERPRISE' classification_type_name")
    known, unknown = B.economics_parts(df, cm, WINDOW, Enterprise.of(dim))
    assert known.count() == 2000 and unknown.count() == 1000 and "Join" in plan_of(known)
    assert not re.search("SortMergeJoin|ShuffledHashJoin|LeftOuter", plan_of(unknown))


def test_as_of_reads_skip_months_closed_before(spark, stored):
    src = tpch_sources(spark, SF_SMALL)
    bridge = H.outlet_bridge(stored.dim_outlet, stored.dim_account, WINDOW.end)
    assert len(re.findall(r"PartitionFilters: \[[^\]]*expired_month", plan_of(bridge))) >= 3
    assert _rows(bridge) == _rows(H.outlet_bridge(src.dim_outlet, src.dim_account, WINDOW.end))
    for day in (dt.date(1993, 5, 31), WINDOW.end, dt.date(2030, 1, 1)):
        for tz in ("Asia/Jakarta", "America/Los_Angeles"):
            assert _rows(H.outlets_as_of(stored.dim_outlet, day, tz)) == _rows(H.outlets_as_of(src.dim_outlet, day, tz))


def test_a_table_without_a_declared_column_is_refused(spark, stored):
    spark.table("l_economics").drop("gmv_amount").createOrReplaceTempView("l_short")
    short = jobs.table_sources(spark, "/nowhere", FX_RATES, tables={"booking_cm": "l_short"})
    with pytest.raises(ValueError, match="gmv_amount"):
        short.booking_cm
    assert restaurant_dim(stored.profile, stored.universe).count() > 0
