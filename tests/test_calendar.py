import datetime as dt

from pyspark.sql import functions as F

from martspark.functions.calendar import (
    in_local_window, local_date, local_datetime_between_dates, month_to_date, utc_bounds)


def test_month_to_date_mid_month():
    w = month_to_date(dt.date(2024, 3, 15))
    assert (w.start, w.end) == (dt.date(2024, 3, 1), dt.date(2024, 3, 14))


def test_month_to_date_first_of_month_is_whole_previous_month():
    w = month_to_date(dt.date(2024, 3, 1))
    assert (w.start, w.end) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    w = month_to_date(dt.date(2024, 1, 1))
    assert (w.start, w.end) == (dt.date(2023, 12, 1), dt.date(2023, 12, 31))


def test_utc_bounds_jakarta():
    lo, hi = utc_bounds(month_to_date(dt.date(1998, 2, 1)))
    assert lo == dt.datetime(1997, 12, 31, 17, 0)
    assert hi == dt.datetime(1998, 1, 31, 17, 0)


def _ts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("ts"))


def test_local_date_at_the_utc_boundary(spark):
    df = _ts(spark, ["2024-01-01 16:59:59", "2024-01-01 17:00:00"])
    got = [r[0] for r in df.select(local_date(F.col("ts"))).collect()]
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def test_local_window_equals_local_date_between(spark):
    w = month_to_date(dt.date(1998, 2, 1))
    df = _ts(spark, ["1997-12-31 16:59:59", "1997-12-31 17:00:00", "1998-01-31 16:59:59",
                     "1998-01-31 17:00:00", None])
    fast = df.where(in_local_window(F.col("ts"), w)).count()
    slow = df.where(w.contains(local_date(F.col("ts")))).count()
    assert fast == slow == 2


def test_literal_datetime_window_cuts_last_day(spark):
    w = month_to_date(dt.date(1998, 2, 1))
    # 1998-01-31 01:00 UTC = 08:00 local on the last day: kept by the date
    # window, dropped by DATETIME BETWEEN date AND date.
    df = _ts(spark, ["1998-01-31 01:00:00", "1998-01-30 16:59:59"])
    literal = df.where(local_datetime_between_dates(F.col("ts"), w)).count()
    repaired = df.where(in_local_window(F.col("ts"), w)).count()
    assert (literal, repaired) == (1, 2)


def test_window_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    _ts(spark, ["1998-01-10 00:00:00"]).write.parquet(path)
    w = month_to_date(dt.date(1998, 2, 1))
    plan = spark.read.parquet(path).where(in_local_window(F.col("ts"), w))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "GreaterThanOrEqual(ts,1997-12-31T17:00)" in plan
    assert "LessThan(ts,1998-01-31T17:00)" in plan


def test_fast_local_time_equals_zone_rules(spark):
    from martspark.functions.calendar import constant_offset, local_datetime
    assert constant_offset("Asia/Jakarta") == dt.timedelta(hours=7)
    assert constant_offset("Europe/Berlin") is None
    vals = ["1950-06-01 12:00:00", "1969-12-31 23:59:59", "1970-01-01 00:00:00", "1998-01-31 16:59:59",
            "1998-01-31 17:00:00", "2024-02-29 23:30:00", "2099-12-31 20:00:00", None]
    df = _ts(spark, vals)
    for tz in ("Asia/Jakarta", "Europe/Berlin", "UTC"):
        got = df.select(local_datetime(F.col("ts"), tz).alias("a"),
                        F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col("ts")).alias("b")).collect()
        assert all(r.a == r.b for r in got), tz
