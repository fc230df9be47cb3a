import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martspark.functions.calendar import month_to_date
from martspark.operators import branches as B
from martspark.operators.dims import Enterprise
from martspark.sources import schemas as S

W = month_to_date(dt.date(1998, 2, 1))


def _ent(spark, ids=(1, 2)):
    dim = spark.createDataFrame([(i, f"uuid-{i}", "ENTERPRISE") for i in ids] + [(9, "uuid-9", "SME")],
                                "restaurant_id long, restaurant_uuid string, classification_type_name string")
    return Enterprise.of(dim)


def test_unnest_is_inner_empty_and_null_lists_drop(spark):
    s = spark.createDataFrame(
        [("o1", [("AKAB", "p", "g", Decimal("1.0"))]), ("o2", []), ("o3", None)],
        S.T.StructType([S.T.StructField("order_no", S.T.StringType()),
                        S.T.StructField("rpl_detail_list", S.T.ArrayType(S.RPL_STRUCT))]))
    inner = s.select("order_no", F.inline("rpl_detail_list"))
    outer = s.select("order_no", F.inline_outer("rpl_detail_list"))
    assert [r.order_no for r in inner.collect()] == ["o1"]
    assert outer.count() == 3


def test_sum_distinct_merges_equal_amounts(spark):
    df = spark.createDataFrame([(10.0,), (10.0,), (5.0,)], "x double")
    assert df.agg(F.sum_distinct("x")).first()[0] == 15.0


def _bookings(spark, rows):
    base = {f.name: None for f in S.BOOKINGS.fields}
    out = []
    for r in rows:
        d = dict(base)
        d.update(r)
        out.append(tuple(d[f.name] for f in S.BOOKINGS.fields))
    return spark.createDataFrame(out, S.BOOKINGS)


def _booking(order, rid, ts, status="3", gmv="30000.00", **kw):
    t = dt.datetime.fromisoformat(ts)
    d = dict(order_no=order, restaurant_id=rid, customer_id=7, created_timestamp=t,
             jakarta_booking_created_date=(t + dt.timedelta(hours=7)).date(), status_id=status,
             actual_gmv_amount=Decimal(gmv), restaurant_accepted_timestamp=t,
             picked_up_timestamp=t + dt.timedelta(seconds=119), booking_to_closed_duration_in_second=3600.0,
             eta_in_minute=30.0)
    d.update(kw)
    return d


def test_aov_pivot_counts_distinct_orders_and_keeps_window(spark):
    bk = _bookings(spark, [
        _booking("o1", 1, "1998-01-10 00:00:00", gmv="24999.99"),
        _booking("o1", 1, "1998-01-10 00:00:00", gmv="24999.99"),   # duplicate row, counted once
        _booking("o2", 1, "1998-01-10 00:00:00", gmv="25000.00"),
        _booking("o3", 1, "1998-01-10 00:00:00", gmv="25000.00", status="1"),  # not completed
        _booking("o4", 9, "1998-01-10 00:00:00"),                    # not enterprise
        _booking("o5", 2, "1997-12-31 16:59:59"),                    # local 12-31: outside
        _booking("o6", 2, "1997-12-31 17:00:00", gmv="300000"),      # local 01-01: inside
    ])
    got = {(r.Food_id, r.summary_data_date): r for r in B.aov_bands_pivot(bk, W, _ent(spark)).collect()}
    assert set(got) == {(1, dt.date(1998, 1, 10)), (2, dt.date(1998, 1, 1))}
    r1 = got[(1, dt.date(1998, 1, 10))]
    assert (r1.a_0_25k, r1.b_25_50k, r1.h_over_250k) == (1, 1, None)
    assert got[(2, dt.date(1998, 1, 1))].h_over_250k == 1


def test_fulfilment_minutes_truncate_and_late_orders(spark):
    bk = _bookings(spark, [
        _booking("o1", 1, "1998-01-10 00:00:00"),  # 119 s -> 1 minute; 60 min <= 35: late
        _booking("o2", 1, "1998-01-10 00:00:00", booking_to_closed_duration_in_second=60.0 * 35),  # not late
    ])
    r = B.fulfilment_ops(bk, W, _ent(spark)).first()
    assert r.total_food_preparation_time_in_minute == 2
    assert r.total_late_delivery_order_number == 1
    assert r.total_eta_in_minute == 60.0


def test_funnel_max_then_sum_is_one_max(spark):
    f = spark.createDataFrame(
        [(dt.date(1998, 1, 5), "uuid-1", 3, 1), (dt.date(1998, 1, 5), "uuid-1", 7, 0),
         (dt.date(1998, 1, 6), "uuid-1", 2, 2), (dt.date(1998, 1, 5), "uuid-9", 5, 5)],
        S.FUNNEL_DAILY)
    out = {(r.summary_data_date, r.restaurant_id): (r.profile_visit, r.add_to_cart)
           for r in B.funnel_daily(f, W, _ent(spark)).collect()}
    assert out == {(dt.date(1998, 1, 5), 1): (7, 1), (dt.date(1998, 1, 6), 1): (2, 2)}


def test_pivot_keeps_groups_with_unlisted_values(spark):
    long = spark.createDataFrame([(dt.date(1998, 1, 1), 1, None, 3), (dt.date(1998, 1, 1), 2, "a_0_25k", 1)],
                                 "summary_data_date date, Food_id long, aov_range_alias string, co long")
    wide = {r.Food_id: r for r in B.pivot_wide(long, "aov_range_alias", ["a_0_25k", "b_25_50k"]).collect()}
    assert wide[1].a_0_25k is None and wide[1].b_25_50k is None
    assert wide[2].a_0_25k == 1


def test_fused_cost_split_equals_unnest_aggregate_join(spark):
    from martspark.functions.money import fx_table
    A = Decimal
    lst = lambda *xs: [(e, p, g, v and A(v)) for e, p, g, v in xs]
    bk = _bookings(spark, [
        _booking("o1", 1, "1998-01-10 00:00:00", Food_mode_name="FOOD-DELIVERY",
                 rpl_detail_list=lst(("AKAB", "Project Abracadabra", "Cofunding", "1.5"), ("X", "p", "g", "2"))),
        # a NULL amount is skipped by the sum; a list of NULL amounts sums to NULL
        _booking("o8", 1, "1998-01-10 00:00:00", Food_mode_name="FOOD-DELIVERY",
                 rpl_detail_list=lst(("AKAB", "p", "Cofunding", "10"), ("AKAB", "p", "g", None))),
        _booking("o9", 1, "1998-01-10 00:00:00", Food_mode_name="FOOD-DELIVERY",
                 rpl_detail_list=lst(("AKAB", "p", "g", None), ("AKAB", "Project Abracadabra", "Cofunding", None))),
        _booking(None, 1, "1998-01-10 00:00:00", Food_mode_name="FOOD-DELIVERY", rpl_detail_list=lst(("AKAB", "p", "g", "7"))),
        _booking("o2", 1, "1998-01-10 00:00:00", Food_mode_name="FOOD-DELIVERY", rpl_detail_list=[]),
        _booking("o3", 1, "1998-01-11 00:00:00", Food_mode_name="FOOD-DELIVERY", rpl_detail_list=None),
        _booking("o4", 2, "1998-01-11 00:00:00", Food_mode_name="FOOD-PICKUP",
                 rpl_detail_list=lst(("AKAB", "p", "g", "3"))),
        _booking("o5", 2, "1998-01-12 00:00:00", Food_mode_name=None, rpl_detail_list=lst(("AKAB", "p", "g", "3"))),
        _booking("o6", 2, "1998-01-12 00:00:00", Food_mode_name="FOOD-DELIVERY",
                 rpl_detail_list=lst(("AKAB", "p", "Cofunding", "4"), ("AKAB", "p", "g", "5"))),
        _booking("o7", 2, "1998-01-13 00:00:00", Food_mode_name="FOOD-DELIVERY",
                 rpl_detail_list=lst(("AKAB", "p", "g", "6"))),
    ])
    cm_rows = [("o1", dt.date(1998, 1, 10)), ("o2", dt.date(1998, 1, 10)), ("o4", dt.date(1998, 1, 11)),
               ("o8", dt.date(1998, 1, 10)), ("o9", dt.date(1998, 1, 10)),
               ("o6", dt.date(1998, 1, 12)), ("o6", dt.date(1998, 1, 12)),   # duplicate economics row
               ("o7", dt.date(1996, 1, 1))]                                 # other year's rate
    cm = spark.createDataFrame(
        [(o, d) + tuple(A("10.0000") for _ in S.ECONOMICS_AMOUNTS) for o, d in cm_rows], S.BOOKING_CM)
    fx = fx_table(spark, {1996: 10000, 1998: 14500})
    bc = B.with_economics(bk, cm, W, _ent(spark))
    explicit = B.order_economics(bc, B.cost_split(bc, fx))
    fused = B.order_economics_fused(*B.economics_parts(bk, cm, W, _ent(spark)), fx)
    cols = explicit.columns
    assert sorted(map(tuple, explicit.select(cols).collect()), key=str) == \
        sorted(map(tuple, fused.select(cols).collect()), key=str)
    got = {r.order_no: (r.akab_rpl_overall, r.rpl_cofunding) for r in fused.collect()}
    assert fused.count() == 8 and got["o8"] == (145000, 145000) and got["o9"] == (None, None)


def test_economics_from_a_second_booking_table(spark):
    """A5: costs come from the first table, modes and economics from the second."""
    from martspark.functions.money import fx_table
    A = Decimal
    cost = [("AKAB", "p", "Cofunding", A("2"))]
    first = _bookings(spark, [_booking("o1", 1, "1998-01-10 00:00:00", Food_mode_name="FOOD-PICKUP", rpl_detail_list=cost),
                              _booking("o2", 1, "1998-01-10 00:00:00", Food_mode_name="FOOD-DELIVERY", rpl_detail_list=cost)])
    second = _bookings(spark, [_booking("o1", 1, "1998-01-10 00:00:00", Food_mode_name="FOOD-DELIVERY", rpl_detail_list=None),
                               _booking("o3", 2, "1998-01-11 00:00:00", Food_mode_name="FOOD-DELIVERY", rpl_detail_list=None)])
    cm = spark.createDataFrame([(o, dt.date(1998, 1, 10)) + tuple(A("10.0000") for _ in S.ECONOMICS_AMOUNTS) for o in ("o1", "o2", "o3")], S.BOOKING_CM)
    fx, ent = fx_table(spark, {1998: 3}), _ent(spark)
    got = B.order_economics(B.with_economics(second, cm, W, ent), B.cost_split(B.with_economics(first, cm, W, ent), fx))
    assert sorted((r.order_no, r.restaurant_id, r.akab_rpl_overall) for r in got.collect()) == [("o1", 1, 6), ("o3", 2, None)]


def test_distinct_counts_shuffle_on_the_distinct_value(spark):
    """A hot restaurant spreads: the first shuffle of COUNT(DISTINCT order)
    is keyed by (day, restaurant, class, order_no), not by the restaurant."""
    bk = _bookings(spark, [_booking(f"o{i}", 1, "1998-01-10 00:00:00") for i in range(5)])
    plan = B.aov_bands_long(bk, W, _ent(spark))._jdf.queryExecution().executedPlan().toString()
    import re
    parts = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any("order_no" in p and "Food_id" in p for p in parts), parts


def test_hot_restaurant_holds_a_third_of_rows(spark):
    rows = [_booking(f"h{i}", 1, f"1998-01-{1 + i % 28:02d} 00:00:00", gmv=str(1000 * (i % 300)))
            for i in range(300)]
    rows += [_booking(f"c{i}", 2 + i % 50, f"1998-01-{1 + i % 28:02d} 00:00:00") for i in range(600)]
    bk = _bookings(spark, rows)
    ent = _ent(spark, ids=tuple(range(1, 52)))
    wide = B.aov_bands_pivot(bk, W, ent)
    bands = ["a_0_25k", "b_25_50k", "c_50_75k", "d_75_100k", "e_100_150k", "f_150_200k", "g_200_250k",
             "h_over_250k"]
    total = sum((r[b] or 0) for r in wide.where("Food_id = 1").collect() for b in bands)
    assert total == 300


def test_economics_history_is_pruned_by_a_runtime_bloom_filter(spark, tmp_path):
    """On physical tables the month's bookings build a bloom filter that
    prunes the economics history before the left join's shuffle."""
    from martspark.plans.session import tune
    tune(spark)
    n = 3000
    bk = _bookings(spark, [_booking(f"o{i}", 1 + i % 2, "1998-01-10 00:00:00" if i < 300 else "1997-06-01 00:00:00",
                                    Food_mode_name="FOOD-DELIVERY") for i in range(n)])
    cm = spark.createDataFrame([(f"o{i}", dt.date(1998, 1, 10)) + tuple(Decimal("1") for _ in S.ECONOMICS_AMOUNTS)
                                for i in range(n)], S.BOOKING_CM)
    bk.write.parquet(str(tmp_path / "bk"))
    cm.write.parquet(str(tmp_path / "cm"))
    keys = ["spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold",
            "spark.sql.autoBroadcastJoinThreshold"]
    prev = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "1KB")
    spark.conf.set(keys[1], "-1")
    try:
        bc = B.with_economics(spark.read.parquet(str(tmp_path / "bk")), spark.read.parquet(str(tmp_path / "cm")),
                              W, _ent(spark))
        plan = bc._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan
        assert bc.where("_cm_order IS NOT NULL").count() == 300
    finally:
        for k, v in zip(keys, prev):
            spark.conf.set(k, v)


def test_completed_orders_daily_equals_three_branches(spark):
    rows = []
    for i in range(60):
        rows.append(_booking(f"o{i % 45}", 1 + i % 3, f"1998-01-{1 + i % 5:02d} 00:00:00",
                             status="3" if i % 7 else "1", gmv=str(1000 * (i * 37 % 300)),
                             sku_promotion_count=i % 2, voucher_discount_amount=Decimal(i % 3),
                             total_campaign_discount_cart_amount=Decimal((i // 3) % 2),
                             booking_to_closed_duration_in_second=60.0 * (i % 50)))
    bk = _bookings(spark, rows)
    ent = _ent(spark, ids=(1, 2))
    one = B.completed_orders_daily(bk, W, ent)
    sep = (B.aov_bands_pivot(bk, W, ent)
           .join(B.promo_class_pivot(bk, W, ent), ["summary_data_date", "Food_id"], "full")
           .join(B.fulfilment_ops(bk, W, ent).withColumnRenamed("jakarta_booking_created_date", "summary_data_date")
                 .withColumnRenamed("restaurant_id", "Food_id"), ["summary_data_date", "Food_id"], "full"))
    cols = sorted(one.columns)
    assert sorted(cols) == sorted(sep.columns)
    a = sorted(map(tuple, one.select(cols).collect()), key=str)
    b = sorted(map(tuple, sep.select(cols).collect()), key=str)
    assert a == b and len(a) > 5
