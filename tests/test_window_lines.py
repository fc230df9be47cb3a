"""Order lines limited to a month's orders, and promo rows read once."""

import datetime as dt

from pyspark.sql import functions as F

from martspark.functions.calendar import in_local_window, month_to_date
from martspark.sources import tpch

W = month_to_date(dt.date(1998, 2, 1))


def _tables(spark):
    at = dt.datetime
    orders = spark.createDataFrame([
        (1, 7, "F", 10.0, at(1998, 1, 5), "5-LOW"),
        (2, 7, "F", 10.0, at(1997, 6, 5), "5-LOW"),
        (3, 8, "F", 10.0, at(1997, 12, 31, 18), "1-URGENT"),  # January in Jakarta
        (4, 8, "F", 10.0, at(1998, 1, 9), "3-MEDIUM"), (4, 8, "F", 10.0, at(1996, 1, 9), "3-MEDIUM"),  # a key of two dates
        (None, 8, "F", 10.0, at(1998, 1, 9), "3-MEDIUM"), (6, 8, "F", 10.0, None, "3-MEDIUM"),
    ], tpch.DRIVER_SCHEMAS["orders"])
    lines = spark.createDataFrame([(k, 1, s, n, 2.0, 100.0 * n, 0.05, 0.02, "R", "O", at(1998, 1, 20))
                                   for k in (1, 2, 3, 4, 6, None) for s in (1, 2, None) for n in (1, 2)], tpch.DRIVER_SCHEMAS["lineitem"])
    return orders, lines


def _rows(df):
    return sorted(map(str, df.collect()))


def test_lines_of_a_window_are_those_of_its_orders(spark):
    orders, lines = _tables(spark)
    few = tpch.lines_of_window(orders, lines, W)
    assert few.columns == lines.columns
    assert _rows(few) == _rows(lines.where("l_orderkey in (1, 3, 4)"))
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    assert _rows(tpch.lines_of_window(orders, lines, W, max_rows=2)) == _rows(lines)


def test_window_lines_give_the_same_month(spark):
    orders, lines = _tables(spark)
    few = tpch.lines_of_window(orders, lines, W)
    month = lambda li: tpch.bookings(orders, li).where(in_local_window(F.col("created_timestamp"), W))
    promo = lambda li: tpch.promo_tx(orders, li).where(W.contains(F.col("jakarta_booking_date")))
    daily = lambda li: tpch.spine_daily(tpch.bookings(orders, li)).where(W.contains(F.col("summary_data_date")))
    # Economics of any date meet the month's bookings by the order number.
    joined = lambda li: month(li).select("order_no").join(tpch.booking_cm(orders, li), "order_no", "left")
    for made in (month, promo, daily, joined):
        assert _rows(made(few)) == _rows(made(lines)) != []


def test_distinct_customers_of_the_promo_mart_read_no_promo_rows(spark, tmp_path):
    from martspark.plans import marts as M
    from martspark.sources.catalog import LazySources
    orders, lines = _tables(spark)
    tpch.bookings(orders, lines).write.parquet(str(tmp_path / "b"))
    tpch.promo_tx(orders, lines).write.parquet(str(tmp_path / "promo"))
    dim = spark.createDataFrame([(1, *["x"] * 10)], "restaurant_id long, " + ", ".join(
        f"{c} string" for c in M.PROMO_KEYS if c not in ("booking_date", "restaurant_id")))
    names = {n: (lambda: None) for n in LazySources.NAMES}
    src = LazySources({**names, "bookings": lambda: spark.read.parquet(str(tmp_path / "b")),
                       "promo_tx": lambda: spark.read.parquet(str(tmp_path / "promo"))})
    out = M.promo_daily(src, dt.date(1998, 2, 1), dimension=dim)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("item_promotion_burnt_amount#") and sum("Relation" in l and "burnt_amount" in l for l in plan.splitlines()) == 1
    assert out.count() > 0
