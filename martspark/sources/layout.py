"""Writers that store the large inputs the way the marts' plans read them.

* Bookings: partitioned by local booking date, so a month reads its own
  folders, and bucketed by order number, so the economics join moves no
  row. Economics: bucketed alike. Both are sorted by order number within a
  file and carry a Parquet Bloom filter on it.
* Promo transactions: partitioned by their local date.
* Histories: partitioned by the month in which a version expired; open
  versions stand in the NULL partition. An as-of read skips the months
  closed before its date.

All of it is Spark's and Parquet's own; the readers need no knowledge beyond
the extra columns named here, and tables without them read as before.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martspark.functions.calendar import DEFAULT_TZ, MonthWindow, local_date, utc_bounds

#: Local date of ``created_timestamp``; its time zone is in the column's metadata.
LOCAL_DATE = "created_local_date"
#: First of the month in which a history row expired; NULL while it is open.
EXPIRED_MONTH = "expired_month"
#: Tasks over which bookings without an order number are dealt.
NULL_SLOTS = 16


def _bucketed(df: DataFrame, table: str, buckets: int, partition: list[str], path: str | None) -> None:
    """Save ``df`` bucketed and sorted by ``order_no``: one task, so one file a partition, for each bucket.

    Rows without an order number belong to one bucket; they are dealt over tasks of their own.
    """
    no = F.col("order_no")
    slot = F.when(no.isNull(), -1 - F.pmod(F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")]), F.lit(NULL_SLOTS))) \
            .otherwise(F.pmod(F.hash(no), F.lit(buckets)))
    dealt = df.repartition(buckets + NULL_SLOTS, slot).sortWithinPartitions(*partition, "order_no")
    writer = (dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, "order_no").sortBy("order_no")
              .option("parquet.bloom.filter.enabled#order_no", "true")
              .option("parquet.bloom.filter.expected.ndv#order_no", "100000"))
    if partition:
        writer = writer.partitionBy(*partition)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_bookings(bookings: DataFrame, table: str, buckets: int, tz: str = DEFAULT_TZ, path: str | None = None) -> None:
    """Bookings by local date and order bucket. ``buckets`` must be that of the economics."""
    day = local_date(F.col("created_timestamp"), tz)
    dated = bookings.withColumn(LOCAL_DATE, day).withMetadata(LOCAL_DATE, {"tz": tz})
    _bucketed(dated, table, buckets, [LOCAL_DATE], path)


def write_economics(booking_cm: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Economics by order bucket."""
    _bucketed(booking_cm, table, buckets, [], path)


def write_promo_tx(promo_tx: DataFrame, path: str) -> None:
    """Promo transactions by local date, a date's rows together."""
    promo_tx.repartition("jakarta_booking_date", F.pmod(F.hash("order_no"), F.lit(8))).write.mode("overwrite") \
        .partitionBy("jakarta_booking_date").parquet(path)


def write_history(history: DataFrame, path: str) -> None:
    """History rows by month of expiry. A closed version never changes: later runs only rewrite months that gained rows."""
    month = F.trunc("expired_timestamp", "MM")
    history.withColumn(EXPIRED_MONTH, month).repartition(EXPIRED_MONTH, F.pmod(F.hash("sf_account_id"), F.lit(8))).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(EXPIRED_MONTH).parquet(path)


def in_window_partitions(df: DataFrame, window: MonthWindow, tz: str = DEFAULT_TZ) -> Column:
    """Partitions of :data:`LOCAL_DATE` that can hold instants of the window in ``tz``; true for tables without it.

    The table's dates may be those of another zone, so the window's first and
    last instants are translated; the exact instant filter stays beside this one.
    """
    if LOCAL_DATE not in df.columns:
        return F.lit(True)
    table_tz = df.schema[LOCAL_DATE].metadata.get("tz", DEFAULT_TZ)
    if table_tz == tz:
        return window.contains(F.col(LOCAL_DATE))
    first, until = utc_bounds(window, tz)
    # A zone is less than a day away from UTC; a day on either side covers it.
    day = dt.timedelta(days=1)
    return F.col(LOCAL_DATE).between(F.lit(first.date() - day), F.lit(until.date() + day))


def open_partitions(until: dt.datetime) -> Column:
    """Partitions of :data:`EXPIRED_MONTH` that can hold versions open at the instant."""
    return F.col(EXPIRED_MONTH).isNull() | (F.col(EXPIRED_MONTH) >= F.lit(until.date().replace(day=1)))
