"""The two daily jobs: build a mart for the run date and refresh its month.

A job reads the mart inputs as tables (one parquet folder per input, named
after the ``Sources`` fields, read with the declared schemas), builds the
mart for the month to date of ``run_date`` and replaces that month in the
target table (J19). ``append=True`` keeps the append-only behaviour of the
KPI job as written (J20: a rerun duplicates the month).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martspark.functions import classify
from martspark.functions.calendar import month_to_date
from martspark.functions.money import fx_table
from martspark.operators.dims import Enterprise, enterprise_slice, restaurant_dim
from martspark.operators.quality import raising_fan_out
from martspark.plans import marts as M
from martspark.plans.joins import WIDE_BROADCAST_ROWS
from martspark.plans.session import scratch_dir, tune
from martspark.sources import layout
from martspark.sources import schemas as S
from martspark.sources.catalog import LazySources
from martspark.sources.layout import EXPIRED_MONTH
from martspark.streaming.refresh import append_month, refresh_month

# Declared schema of each input table.
INPUT_SCHEMAS = {
    "bookings": S.BOOKINGS,
    "booking_cm": S.BOOKING_CM,
    "econ_bookings": S.BOOKINGS,  # optional second booking table
    "promo_tx": S.PROMO_TX,
    "spine": S.SPINE_DAILY,
    "ads": S.ADS_DAILY,
    "funnel": S.FUNNEL_DAILY,
    "rating": S.RATING_DAILY,
    "impressions": S.IMPRESSION_DAILY,
    "profile": S.PROFILE,
    "universe": S.UNIVERSE,
    "geo": S.GEO,
    "dim_outlet": S.DIM_OUTLET,
    "dim_account": S.DIM_ACCOUNT,
}


def table_sources(spark: SparkSession, base: str, fx_rates: Mapping[int, float],
                  paths: Mapping[str, str] | None = None, tables: Mapping[str, str] | None = None,
                  second_bookings: bool = False) -> LazySources:
    """Mart inputs read from parquet tables under ``base`` (or ``paths``), or from catalog ``tables``.

    Catalog tables are those of :mod:`martspark.sources.layout`; their columns are checked against the
    declared schema, and the layout's own columns are kept. ``second_bookings`` says that there is a
    second booking table (A5), ``econ_bookings``.
    """
    paths, tables = dict(paths or {}), dict(tables or {})

    def reader(name: str):
        if name in tables:
            return lambda: S.check_columns(spark.table(tables[name]), INPUT_SCHEMAS[name], name)
        path = paths.get(name, f"{base.rstrip('/')}/{name}")
        schema = INPUT_SCHEMAS[name]
        if name in ("dim_outlet", "dim_account"):  # stored by expiry month, or plain

            def history() -> DataFrame:
                found = S.check_columns(spark.read.parquet(path), schema, name)
                dated = T.StructType([*schema.fields, T.StructField(EXPIRED_MONTH, T.DateType())])
                return spark.read.schema(dated if EXPIRED_MONTH in found.columns else schema).parquet(path)
            return history
        return lambda: spark.read.schema(schema).parquet(path)

    builders = {name: reader(name) for name in INPUT_SCHEMAS if name != "econ_bookings" or second_bookings or name in tables or name in paths}
    builders["fx"] = lambda: fx_table(spark, fx_rates)
    return LazySources(builders)


def write_bookings(spark: SparkSession, bookings: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Store bookings for :func:`run_kpi_job`: by local date, bucketed by order number."""
    layout.write_bookings(bookings, table, buckets, path=path)


def write_economics(spark: SparkSession, booking_cm: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Store economics bucketed as the bookings are, so that their join moves neither."""
    layout.write_economics(booking_cm, table, buckets, path)


def written(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` written once to the shared scratch folder, and its rows, counted on the way."""
    spark, rows = df.sparkSession, Observation(name)
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), rows.get["n"]


def _write(mart: DataFrame, target: str, month: dt.date, append: bool, allow_empty: bool) -> None:
    with raising_fan_out():
        if append:
            append_month(mart, target)
        else:
            refresh_month(mart, target, month, allow_empty=allow_empty)


def run_kpi_job(spark: SparkSession, src, run_date: dt.date, target: str,
                append: bool = False, allow_empty: bool = False, prune: bool = False) -> None:
    """Monthly KPI mart for the month to date of ``run_date`` into ``target``.

    The enterprise slice of the dimension is written once; its checks and the mart read that table.
    ``prune`` is for economics stored by :func:`write_economics`.
    """
    tune(spark)
    dim, _ = written(enterprise_slice(restaurant_dim(src.profile, src.universe)), "restaurant-dim")
    mart = M.kpi_monthly(src, run_date, ent=Enterprise.of(dim), prune=prune)
    _write(mart, target, month_to_date(run_date).month, append, allow_empty)


def run_promo_job(spark: SparkSession, src, run_date: dt.date, target: str,
                  tiers: classify.CityTiers = classify.CityTiers(),
                  append: bool = False, allow_empty: bool = False) -> None:
    """Daily promo mart for the month to date of ``run_date`` into ``target``
    (partitioned by ``booking_month``, the month its rows are replaced by).

    The enriched dimension with its bridge is computed once, into a table; a restaurant with two rows
    fails that step, before the mart is built.
    """
    tune(spark)
    with raising_fan_out():
        dim, rows = written(M.promo_dimension(src, run_date), "promo-dim")
    if rows <= WIDE_BROADCAST_ROWS:
        dim = F.broadcast(dim)
    mart = M.with_month(M.promo_daily(src, run_date, tiers=tiers, dimension=dim), "booking_date")
    _write(mart, target, month_to_date(run_date).month, append, allow_empty)
