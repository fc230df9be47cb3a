"""The daily jobs run from input tables as a user would run them."""

import datetime as dt

import pytest
from paths import SF_SMALL
from pyspark.sql import functions as F

from martspark.operators.quality import FanOutError, raising_fan_out
from martspark.plans import jobs
from martspark.plans import marts as M
from martspark.plans.slate import DRIVER_TIERS
from martspark.sources.catalog import LazySources
from martspark.sources.tpch import FX_RATES, RUN_DATE, tpch_sources
from martspark.streaming.refresh import read_mart


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_jobs_from_tables_equal_the_marts(spark, tmp_path):
    src = tpch_sources(spark, SF_SMALL)
    base = str(tmp_path / "inputs")
    for name in LazySources.NAMES:
        if name == "econ_bookings":  # optional, not set
            continue
        if name != "fx":
            getattr(src, name).write.parquet(f"{base}/{name}")
    tables = jobs.table_sources(spark, base, FX_RATES)

    kpi_target = str(tmp_path / "kpi")
    jobs.run_kpi_job(spark, tables, RUN_DATE, kpi_target)
    jobs.run_kpi_job(spark, tables, RUN_DATE, kpi_target)          # rerun: replaced, not doubled
    got = read_mart(spark, kpi_target, M.KPI_COLUMNS)
    want = M.kpi_monthly(src, RUN_DATE)
    assert _rows(got, M.KPI_COLUMNS) == _rows(want, M.KPI_COLUMNS)

    promo_target = str(tmp_path / "promo")
    for run in (dt.date(1998, 1, 1), RUN_DATE):
        jobs.run_promo_job(spark, tables, run, promo_target, tiers=DRIVER_TIERS)
    got = read_mart(spark, promo_target, M.PROMO_COLUMNS + ["booking_month"])
    months = sorted({r.booking_month for r in got.select("booking_month").distinct().collect()})
    assert months == [dt.date(1997, 12, 1), dt.date(1998, 1, 1)]
    jan = got.where("booking_month = DATE'1998-01-01'").select(*M.PROMO_COLUMNS)
    assert _rows(jan, M.PROMO_COLUMNS) == _rows(M.promo_daily(src, RUN_DATE, tiers=DRIVER_TIERS), M.PROMO_COLUMNS)


def test_a_restaurant_with_two_rows_fails_before_the_switch(spark, tmp_path):
    src = tpch_sources(spark, SF_SMALL)
    target = str(tmp_path / "promo")
    jobs.run_promo_job(spark, src, RUN_DATE, target, tiers=DRIVER_TIERS)
    before = _rows(read_mart(spark, target, M.PROMO_COLUMNS), M.PROMO_COLUMNS)
    twice = tpch_sources(spark, SF_SMALL)
    renamed = src.profile.withColumn("brand_name", F.concat("brand_name", F.lit(" again")))
    twice._built["profile"] = src.profile.unionByName(renamed)
    with pytest.raises(FanOutError, match="enriched restaurant dimension.* x2"):
        jobs.run_promo_job(spark, twice, RUN_DATE, target, tiers=DRIVER_TIERS)
    with pytest.raises(FanOutError, match="enterprise restaurant dimension"):
        jobs.run_kpi_job(spark, twice, RUN_DATE, str(tmp_path / "kpi"))
    # The query itself fails while it runs; building it starts no job.
    mart = M.promo_daily(twice, RUN_DATE, tiers=DRIVER_TIERS)
    with pytest.raises(FanOutError), raising_fan_out():
        mart.collect()
    assert _rows(read_mart(spark, target, M.PROMO_COLUMNS), M.PROMO_COLUMNS) == before


def test_jobs_with_a_second_booking_table(spark, tmp_path):
    src = tpch_sources(spark, SF_SMALL, second_bookings=True)
    base = str(tmp_path / "inputs")
    for name in LazySources.NAMES:
        if name != "fx":
            getattr(src, name).write.parquet(f"{base}/{name}")
    tables = jobs.table_sources(spark, base, FX_RATES, second_bookings=True)
    jobs.run_kpi_job(spark, tables, RUN_DATE, str(tmp_path / "kpi"))
    got = _rows(read_mart(spark, str(tmp_path / "kpi"), M.KPI_COLUMNS), M.KPI_COLUMNS)
    assert got == _rows(M.kpi_monthly(src, RUN_DATE), M.KPI_COLUMNS)
    assert got != _rows(M.kpi_monthly(tpch_sources(spark, SF_SMALL), RUN_DATE), M.KPI_COLUMNS)


def test_append_job_duplicates_on_rerun(spark, tmp_path):
    src = tpch_sources(spark, SF_SMALL)
    target = str(tmp_path / "kpi")
    for _ in range(2):
        jobs.run_kpi_job(spark, src, RUN_DATE, target, append=True)
    n = M.kpi_monthly(src, RUN_DATE).count()
    assert read_mart(spark, target, M.KPI_COLUMNS).count() == 2 * n


def test_literal_rating_cutoff_only_drops_ratings(spark):
    src = tpch_sources(spark, SF_SMALL)
    rep = {r.Food_id: r for r in M.kpi_monthly(src, RUN_DATE).collect()}
    lit = {r.Food_id: r for r in M.kpi_monthly(src, RUN_DATE, literal_rating_cutoff=True).collect()}
    assert rep.keys() == lit.keys()
    for k in rep:
        assert lit[k].total_rating_number <= rep[k].total_rating_number
        assert lit[k].gmv == rep[k].gmv and lit[k].cm == rep[k].cm
