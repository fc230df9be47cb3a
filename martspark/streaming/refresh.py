"""Re-runnable month refresh of a mart table.

The reference has no stream: its only rule for late rows is to recompute
the month to date every day and replace that month in the target. Here
every run writes its rows to a version of its own, checks them, and then
switches the month to it by one small append:

* ``data/version=<v>/booking_month=<m>/`` holds the rows of one run;
* ``switches`` has one row for each run and month: month, version, kind
  (``replace``, ``append`` or ``clear``). Versions sort by the time they were made.

:func:`read_mart` reads of every month the version of its last ``replace`` and
what was appended after it. Until the switch is appended, readers see the old
month, whole; a run that fails before leaves only a version that nobody reads.
A rerun gives the same rows.

* :func:`refresh_month` (J19) replaces one month. An empty month fails by
  default or, with ``allow_empty=True``, clears it (what DELETE + INSERT
  would leave).
* :func:`append_month` (J20) is the append-only job: a rerun duplicates.

Task retries and lost executors are covered by Spark's commit protocol:
files of failed attempts are never committed. Versions no longer read can be
deleted by age; the library never deletes data.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

PARTITION = "booking_month"
_SWITCHES = "month date, version string, kind string"


class EmptyMonthError(ValueError):
    pass


def _write_version(df: DataFrame, target: str, partition_col: str) -> str:
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.partitionBy(partition_col).parquet(f"{target.rstrip('/')}/data/version={version}")
    return version


def _switch(spark: SparkSession, target: str, rows: list[tuple[dt.date, str, str]]) -> None:
    """One file appended: readers see all of it or nothing."""
    spark.createDataFrame(rows, _SWITCHES).coalesce(1).write.mode("append").parquet(f"{target.rstrip('/')}/switches")


def refresh_month(df: DataFrame, target: str, month: dt.date, partition_col: str = PARTITION,
                  allow_empty: bool = False) -> None:
    """Replace month ``month`` of ``target`` with ``df``.

    ``df`` must hold rows of that month only. It is computed once: rows are
    counted as they are written, and the month is switched after the counts are right.
    """
    spark = df.sparkSession
    seen = Observation("refresh")
    part = F.col(partition_col)
    watched = df.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(part.isNull() | (part != F.lit(month))).alias("stray"))
    version = _write_version(watched, target, partition_col)
    counts = seen.get
    if counts["stray"]:
        raise ValueError(f"refresh of {month}: rows of other months in the input")
    if counts["n"] == 0 and not allow_empty:
        raise EmptyMonthError(f"refresh of {month}: no rows; pass allow_empty=True to clear the month")
    _switch(spark, target, [(month, version, "replace" if counts["n"] else "clear")])


def append_month(df: DataFrame, target: str, partition_col: str = PARTITION) -> None:
    """Append the mart rows (no delete; a rerun duplicates the month)."""
    spark = df.sparkSession
    version = _write_version(df, target, partition_col)
    months = spark.read.schema(df.schema).parquet(f"{target.rstrip('/')}/data/version={version}").select(partition_col).distinct().collect()
    if months:
        _switch(spark, target, [(r[0], version, "append") for r in months])


def live_versions(spark: SparkSession, target: str) -> list[tuple[dt.date, str]]:
    """(month, version) of everything that is read: a few rows a month."""
    switches = spark.read.schema(_SWITCHES).parquet(f"{target.rstrip('/')}/switches")
    base = switches.where("kind <> 'append'").groupBy(F.col("month").alias("_month")).agg(F.max("version").alias("since"))
    live = switches.join(base, F.col("month") == F.col("_month"), "left").where(
        (F.col("kind") != "clear") & (F.col("since").isNull() | (F.col("version") >= F.col("since"))))
    return sorted((r[0], r[1]) for r in live.select("month", "version").collect())


def read_mart(spark: SparkSession, target: str, columns: list[str], partition_col: str = PARTITION) -> DataFrame:
    """Read a mart back in its positional column order."""
    data = f"{target.rstrip('/')}/data"
    live = live_versions(spark, target)
    if not live:  # every month cleared
        return spark.read.parquet(data).select(*columns).limit(0)
    paths = [f"{data}/version={v}/{partition_col}={m.isoformat()}" for m, v in live]
    return spark.read.option("basePath", data).parquet(*paths).select(*columns)
