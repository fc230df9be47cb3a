import datetime as dt

import pytest
from pyspark.sql import functions as F

from martspark.plans.session import scratch_dir
from martspark.streaming.refresh import EmptyMonthError, append_month, read_mart, refresh_month

COLS = ["k", "v", "booking_month"]


def _mart(spark, month, rows):
    return spark.createDataFrame([(k, v) for k, v in rows], "k long, v long").withColumn(
        "booking_month", F.lit(month))


def _all(spark, target):
    return sorted(tuple(r) for r in read_mart(spark, target, COLS).collect())


def test_refresh_replaces_only_its_month_and_is_idempotent(spark, tmp_path):
    target = str(tmp_path / "mart")
    dec, jan = dt.date(1997, 12, 1), dt.date(1998, 1, 1)
    refresh_month(_mart(spark, dec, [(1, 10), (2, 20)]), target, dec)
    refresh_month(_mart(spark, jan, [(1, 1)]), target, jan)
    before = [r for r in _all(spark, target) if r[2] == dec]
    refresh_month(_mart(spark, jan, [(1, 2), (3, 3)]), target, jan)
    once = _all(spark, target)
    refresh_month(_mart(spark, jan, [(1, 2), (3, 3)]), target, jan)
    assert _all(spark, target) == once
    assert [r for r in once if r[2] == dec] == before
    assert [r[:2] for r in once if r[2] == jan] == [(1, 2), (3, 3)]


def test_empty_month_fails_or_clears(spark, tmp_path):
    target = str(tmp_path / "mart")
    jan = dt.date(1998, 1, 1)
    refresh_month(_mart(spark, jan, [(1, 1)]), target, jan)
    empty = _mart(spark, jan, []).where("k < 0")
    with pytest.raises(EmptyMonthError):
        refresh_month(empty, target, jan)
    refresh_month(_mart(spark, dt.date(1997, 12, 1), [(5, 5)]), target, dt.date(1997, 12, 1))
    refresh_month(empty, target, jan, allow_empty=True)
    assert [r[0] for r in _all(spark, target)] == [5]


def test_readers_see_the_old_month_until_the_switch(spark, tmp_path, monkeypatch):
    from martspark.streaming import refresh
    target = str(tmp_path / "mart")
    dec, jan = dt.date(1997, 12, 1), dt.date(1998, 1, 1)
    refresh_month(_mart(spark, dec, [(9, 9)]), target, dec)
    refresh_month(_mart(spark, jan, [(1, 1), (2, 2)]), target, jan)
    before, reader = _all(spark, target), read_mart(spark, target, COLS)
    with monkeypatch.context() as m:
        m.setattr(refresh, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("lost between write and switch")))
        with pytest.raises(RuntimeError, match="between"):
            refresh_month(_mart(spark, jan, [(7, 7)]), target, jan)
    assert _all(spark, target) == before
    refresh_month(_mart(spark, jan, [(7, 7)]), target, jan)
    # A reader that started before the switch still finds its files.
    assert sorted(tuple(r) for r in reader.collect()) == before
    assert [r[:2] for r in _all(spark, target)] == [(7, 7), (9, 9)]


def test_append_and_replace_of_one_month(spark, tmp_path):
    target = str(tmp_path / "mart")
    jan = dt.date(1998, 1, 1)
    append_month(_mart(spark, jan, [(1, 1)]), target)
    append_month(_mart(spark, jan, [(2, 2)]), target)
    assert [r[0] for r in _all(spark, target)] == [1, 2]
    refresh_month(_mart(spark, jan, [(3, 3)]), target, jan)
    append_month(_mart(spark, jan, [(4, 4)]), target)
    assert [r[0] for r in _all(spark, target)] == [3, 4]
    refresh_month(_mart(spark, jan, []).where("k < 0"), target, jan, allow_empty=True)
    assert _all(spark, target) == [] and read_mart(spark, target, COLS).columns == COLS


def test_rows_of_other_months_are_rejected(spark, tmp_path):
    with pytest.raises(ValueError, match="other months"):
        refresh_month(_mart(spark, dt.date(1997, 12, 1), [(1, 1)]), str(tmp_path / "m"), dt.date(1998, 1, 1))


def test_append_doubles_on_rerun(spark, tmp_path):
    target = str(tmp_path / "mart")
    jan = dt.date(1998, 1, 1)
    for _ in range(2):
        append_month(_mart(spark, jan, [(1, 1), (2, 2)]), target)
    assert len(_all(spark, target)) == 4


def test_scratch_folder_is_the_shared_one(spark):
    folder = scratch_dir(spark)
    assert folder == scratch_dir(spark) and folder in (
        (spark.conf.get("spark.checkpoint.dir", None) or "").rstrip("/"), (spark.sparkContext.getCheckpointDir() or "").rstrip("/"))
