"""Adapters: reference-shaped mart inputs built from the driver tables.

Restaurant = supplier; one booking = one (order, supplier) pair of
``lineitem`` joined to ``orders``; event-grain daily tables come from
``events`` shifted to local time and back 26 years; type-2 history comes
from each customer's order sequence. Everything is lazy: the marts' window
filters reach the ``orders`` / ``events`` scans through these plans.

Money is exact: integer cents and percent points per line, DECIMAL(18,2)
and DECIMAL(18,4) per booking; durations and counts are whole numbers, so
every sum is exact.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martspark.functions.calendar import MonthWindow, in_local_window, local_date
from martspark.functions.money import fx_table
from martspark.plans.joins import DEFAULT_BROADCAST_ROWS
from martspark.sources import schemas as S
from martspark.sources.catalog import LazySources

# Driver mapping: the run date whose window is 1998-01-01 .. 1998-01-31.
RUN_DATE = dt.date(1998, 2, 1)

# FIXED VALUES: one FX rate per year of the driver data (local currency
# per unit), the literal relation A15.
FX_RATES = {
    1992: 2000, 1993: 2100, 1994: 2200, 1995: 9500, 1996: 10000,
    1997: 11000, 1998: 14500, 1999: 15000, 2000: 15500, 2001: 16000,
    2002: 16500,
}

# Declared schemas of the driver tables read here: a declared schema spares
# the footer reads of schema inference on every query.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
TABLES = list(DRIVER_SCHEMAS)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in DRIVER_SCHEMAS:
        return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def _amount(c: Column) -> Column:
    return c.cast(S.AMOUNT)


# Line money is exact integer arithmetic: prices in cents, discount and tax
# in percent points, so price * rate is a whole number of 1e-4 units. Sums
# stay BIGINT (fast, codegen) and become decimals once per group.
def _units_to_amount(units: Column) -> Column:
    """BIGINT count of 1e-4 units -> DECIMAL(18,4)."""
    return _amount(units.cast("decimal(22,0)") * F.lit("0.0001").cast("decimal(4,4)"))


def _cents_to_gmv(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(S.GMV)


def _lines(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Order lines with the order's attributes and integer money columns.

    ``pc`` price in cents, ``dp``/``tp`` discount/tax in percent points
    (the driver values have two decimals, so the rounding is exact).
    """
    li = lineitem.select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus",
        "l_shipdate", "l_discount", "l_tax",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("pc"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("dp"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("tp"),
    )
    od = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       "o_orderdate", "o_orderpriority")
    return od.join(li, od.o_orderkey == li.l_orderkey, "inner")


def _pd() -> Column:
    """price * discount, in 1e-4 units."""
    return F.col("pc") * F.col("dp")


def _pt() -> Column:
    """price * tax, in 1e-4 units."""
    return F.col("pc") * F.col("tp")

# (name, line condition or None, base, NULL for o_orderkey % n == 0)
_RPL_SPEC = [
    ("estimated_rpl_total_amount", None, "disc", None),
    ("rpl_voucher_amount", ("l_returnflag", "R"), "disc", None),
    ("rpl_markdown_delivery_subsidy_amount", ("l_linestatus", "F"), "tax", None),
    ("rpl_markdown_direct_discount_amount", ("l_linestatus", "O"), "disc", None),
    ("rpl_subscription_amount", None, "tax", 4),
    ("rpl_markdown_gopay_coins_issuance_amount", None, "one_pct", None),
    ("rpl_gopay_coins_redemption_amount", ("l_returnflag", "A"), "disc", None),
    ("rpl_mission_cashback_amount", ("l_returnflag", "N"), "tax", None),
    ("rpl_invoice_adjustment_amount", None, "disc", 6),
    ("rpl_dynamic_platform_fee_discount_amount", ("l_linestatus", "F"), "disc", None),
    ("economical_delivery_discount_amount", ("l_linestatus", "O"), "tax", None),
]


def _rpl_amount(name: str, cond, base: str, null_mod) -> Column:
    v = {"disc": _pd, "tax": _pt, "one_pct": lambda: F.col("pc")}[base]()
    if cond is not None:
        v = F.when(F.col(cond[0]) == cond[1], v).otherwise(F.lit(0))
    total = _units_to_amount(F.sum(v))
    if null_mod is not None:
        total = F.when(F.col("o_orderkey") % null_mod == 0, F.lit(None).cast(S.AMOUNT)).otherwise(total)
    return total.alias(name)


def bookings(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """A3/A5: one row per (order, supplier) with the booking's columns.

    Order attributes are grouping keys (functionally dependent on the
    order key), so predicates on them are pushed below the aggregate and
    the join into the ``orders`` side. The join output is hash-partitioned
    on the order key, which already clusters the grouping keys: one shuffle.
    """
    keys = ["o_orderkey", "l_suppkey", "o_custkey", "o_orderstatus", "o_totalprice",
            "o_orderdate", "o_orderpriority"]
    agg = _lines(orders, lineitem).groupBy(*keys).agg(
        F.max("l_shipdate").alias("picked_up_timestamp"),
        F.max("l_quantity").alias("_max_qty"),
        _cents_to_gmv(F.sum("pc")).alias("normalized_gmv_amount"),
        F.sum(F.when(F.col("l_discount") > 0.05, 1).otherwise(0)).cast("bigint").alias("sku_promotion_count"),
        _units_to_amount(F.sum(F.when(F.col("l_tax") > 0.04, _pt()).otherwise(F.lit(0))))
        .alias("total_campaign_discount_cart_amount"),
        _units_to_amount(F.sum(F.when(F.col("l_returnflag") == "R", _pd()).otherwise(F.lit(0))))
        .alias("voucher_discount_amount"),
        *[_rpl_amount(*spec) for spec in _RPL_SPEC],
        F.collect_list(F.struct(
            F.when(F.col("l_linestatus") == "F", "AKAB").otherwise("MERCHANT").alias("budget_entity_name"),
            F.when(F.col("l_returnflag") == "A", "Project Abracadabra").otherwise("Regular Program").alias("program_name"),
            F.when(F.col("l_returnflag") == "N", "Cofunding").otherwise("Platform").alias("program_group_name"),
            # lines without a discount carry no amount
            F.when(F.col("dp") != 0, _units_to_amount(_pd())).alias("Food_spend_amount"),
        )).alias("rpl_detail_list"),
    )
    status = (F.when(F.col("o_orderstatus") == "F", "3")
               .when(F.col("o_orderstatus") == "P", "2").otherwise("1"))
    mode = (F.when(F.col("o_orderpriority") == "5-LOW", "FOOD-PICKUP")
             .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("string"))
             .otherwise("FOOD-DELIVERY"))
    pas = (F.when(F.col("o_orderkey") % 5 == 0, F.lit(None).cast("boolean"))
            .otherwise(F.col("o_orderkey") % 5 != 1))
    return agg.select(
        F.concat_ws("-", "o_orderkey", "l_suppkey").alias("order_no"),
        F.col("l_suppkey").alias("restaurant_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("created_timestamp"),
        local_date(F.col("o_orderdate")).alias("jakarta_booking_created_date"),
        status.alias("status_id"),
        mode.alias("Food_mode_name"),
        F.col("o_orderdate").alias("restaurant_accepted_timestamp"),
        "picked_up_timestamp",
        F.expr("timestampdiff(SECOND, o_orderdate, picked_up_timestamp)").cast("double")
         .alias("booking_to_closed_duration_in_second"),
        (F.col("_max_qty") * 1440).cast("double").alias("eta_in_minute"),
        F.col("o_totalprice").cast(S.GMV).alias("actual_gmv_amount"),
        "normalized_gmv_amount", "sku_promotion_count",
        "total_campaign_discount_cart_amount", "voucher_discount_amount",
        pas.alias("food_pas_flag"),
        *S.RPL_AMOUNT_COLUMNS,
        "rpl_detail_list",
    )


def econ_bookings(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """A5: the second booking table, another feed of the same orders: no urgent ones, other pickup orders, no cost list."""
    mode = (F.when(F.col("o_orderpriority") == "3-MEDIUM", "FOOD-PICKUP")
             .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("string"))
             .otherwise("FOOD-DELIVERY"))
    return _lines(orders, lineitem).where(F.col("o_orderpriority") != "1-URGENT").select(
        F.concat_ws("-", "o_orderkey", "l_suppkey").alias("order_no"),
        F.col("l_suppkey").alias("restaurant_id"),
        F.col("o_orderdate").alias("created_timestamp"),
        mode.alias("Food_mode_name"),
    ).distinct().withColumn("rpl_detail_list", F.lit(None).cast(S.BOOKINGS["rpl_detail_list"].dataType))


def booking_cm(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """A4: booking economics per booking; pending orders have no row yet."""
    pc = F.col("pc")
    lines = _lines(orders, lineitem).where(F.col("o_orderstatus") != "P")
    agg = lines.groupBy("o_orderkey", "l_suppkey", "o_orderdate").agg(
        _units_to_amount(F.sum(pc * (100 - F.col("dp")))).alias("cm_amount"),
        _units_to_amount(F.sum(pc * 70)).alias("cost_of_revenue_amount"),
        _units_to_amount(F.sum(pc * 100)).alias("gtv_amount"),
        _units_to_amount(F.sum(_pt())).alias("gross_take_preoffset_amount"),
        _units_to_amount(F.sum(pc * 20)).alias("merchant_commission_amount"),
        _units_to_amount(F.sum(_pd())).alias("mfp_markdown_amount"),
        _units_to_amount(F.sum(F.when(F.col("l_linestatus") == "F", _pd()).otherwise(F.lit(0)))).alias("net_rpl_amount"),
        _units_to_amount(F.sum(pc * (F.col("dp") + F.col("tp")))).alias("gross_rpl_amount"),
        _units_to_amount(F.sum(pc * 100)).alias("gmv_amount"),
    )
    return agg.select(
        F.concat_ws("-", "o_orderkey", "l_suppkey").alias("order_no"),
        local_date(F.col("o_orderdate")).alias("booking_date"),
        F.when(F.col("o_orderkey") % 9 == 0, F.lit(None).cast(S.AMOUNT))
         .otherwise(F.col("cm_amount")).alias("cm_amount"),
        *S.ECONOMICS_AMOUNTS[1:],
    )


def promo_tx(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Promo transactions per booking (lines with a discount of 2% or more)."""
    lines = _lines(orders, lineitem).where(F.col("l_discount") >= 0.02)
    sku = F.sum(_pd())
    cart = F.sum(F.when(F.col("l_tax") > 0.04, _pt()).otherwise(F.lit(0)))
    voucher = F.sum(F.when(F.col("l_returnflag") == "R", _pd()).otherwise(F.lit(0)))
    agg = lines.groupBy("o_orderkey", "l_suppkey", "o_orderdate", "o_custkey", "o_orderpriority").agg(
        _units_to_amount(sku).alias("item_promotion_burnt_amount"),
        _units_to_amount(cart).alias("campaign_discount_burnt_amount"),
        _units_to_amount(voucher).alias("voucher_burnt_amount"),
        _units_to_amount(sku + cart + voucher).alias("total_order_burnt_amount"),
        _cents_to_gmv(F.sum("pc")).alias("gmv_amount"),
    )
    return agg.select(
        F.concat_ws("-", "o_orderkey", "l_suppkey").alias("order_no"),
        local_date(F.col("o_orderdate")).alias("jakarta_booking_date"),
        "item_promotion_burnt_amount", "campaign_discount_burnt_amount", "voucher_burnt_amount",
        "total_order_burnt_amount",
        F.col("o_custkey").alias("customer_id"),
        F.lit("FOOD").alias("restaurant_type"),
        "gmv_amount",
        F.col("o_orderpriority").alias("payment_type"),
    )


def spine_daily(bk: DataFrame) -> DataFrame:
    """Daily merchant summary, (local date, restaurant) grain."""
    done = F.col("status_id") == "3"
    g = F.col("normalized_gmv_amount")

    def pct(x: str) -> Column:
        return g * F.lit(x).cast("decimal(4,3)")

    return bk.groupBy(
        F.col("jakarta_booking_created_date").alias("summary_data_date"),
        F.col("restaurant_id").alias("Food_id"),
    ).agg(
        _amount(F.sum(F.when(done, g))).alias("completed_Food_gmv_amount"),
        _amount(F.sum(F.when(done, F.col("total_campaign_discount_cart_amount")))).alias("completed_Food_mfp_markdown_amount"),
        _amount(F.sum(F.when(done, F.col("estimated_rpl_total_amount")))).alias("completed_Food_mfp_sku_amount"),
        _amount(F.sum(F.when(done, F.col("voucher_discount_amount")))).alias("completed_Food_mfp_voucher_amount"),
        _amount(F.sum(F.when(done, pct("0.200")))).alias("completed_merchant_commission_amount"),
        _amount(F.sum(F.when(done, F.col("rpl_voucher_amount")))).alias("completed_Food_estimated_rpl_amount"),
        _amount(F.sum(pct("0.010"))).alias("ads_booked_amount"),
        _amount(F.sum(pct("0.008"))).alias("ads_realized_amount"),
        _amount(F.sum(F.when(done, pct("0.006")))).alias("ads_booked_paid_revenue_amount"),
        _amount(F.sum(F.when(done, pct("0.005")))).alias("ads_realized_paid_revenue_amount"),
        F.sum(F.when(done, 1).otherwise(0)).cast("bigint").alias("completed_Food_order_number"),
        F.count(F.lit(1)).alias("all_Food_order_number"),
    )


def _events_local(events: DataFrame) -> DataFrame:
    shifted_utc = F.col("ts") - F.make_ym_interval(F.lit(26))
    return events.select(
        "event_id", "user_id", "event_type", "value",
        shifted_utc.alias("utc_ts"),
        F.to_date(shifted_utc + F.make_dt_interval(hours=F.lit(7))).alias("local_date"),
        F.concat(F.lit("uuid-"), F.col("user_id")).alias("restaurant_uuid"),
    )


def ads_daily(events: DataFrame) -> DataFrame:
    """Paid-ads campaign rows, one per event."""
    e = _events_local(events)
    eid = F.col("event_id")
    member = (F.when(F.col("event_type").isin("purchase", "click"), "PAID")
               .when(F.col("event_type") == "view", "FREE")
               .when(F.col("event_type") == "signup", "Shadow"))
    inventory = (F.when(eid % 7 == 0, "Food Search Ads").when(eid % 7 == 1, "Food Category Ads")
                  .when(eid % 7 == 2, "Food CPC Fungible Ads").when(eid % 7 == 3, "Food Top Banner")
                  .when(eid % 7 == 4, "Partner Jempolan").when(eid % 7 == 5, "Food Masthead")
                  .otherwise("Food Brand Ads"))
    channel = (F.when(eid % 5 == 0, "recommended_package").when(eid % 5 == 1, "cms_upload")
                .when(eid % 5 == 2, "self_serve_wizard").when(eid % 5 == 3, "organic"))
    v = F.col("value").cast(S.GMV)
    return e.select(
        F.col("local_date").alias("jakarta_data_date"),
        F.date_add(F.col("local_date"), (eid % 40 - 10).cast("int")).alias("jakarta_end_date"),
        "restaurant_uuid",
        member.alias("member_type"),
        inventory.alias("inventory_name"),
        channel.alias("sales_channel_name"),
        v.alias("booked_revenue_amount"),
        _amount(v * F.lit(0.9).cast("decimal(2,1)")).alias("billed_revenue_amount"),
        (v * 10).cast(S.GMV).alias("direct_gmv_amount"),
        (v * 4).cast(S.GMV).alias("indirect_gmv_amount"),
        (eid % 1000).alias("realized_impression_count"),
        (eid % 50).alias("realized_click_count"),
        (eid % 3).alias("direct_completed_order_count"),
        (eid % 4).alias("indirect_completed_order_count"),
        (F.col("user_id") % 5).alias("new_user_count"),
        (eid % 6).alias("existing_user_count"),
        (eid % 2).alias("dormant_user_count"),
    )


def funnel_daily(events: DataFrame) -> DataFrame:
    """App funnel rows (several per restaurant and day)."""
    e = _events_local(events).where(F.col("event_type").isin("view", "click"))
    return e.select(
        F.col("local_date").alias("summary_data_date"), "restaurant_uuid",
        (F.col("event_id") % 17).alias("profile_visit_over_merchant_count"),
        (F.col("event_id") % 5).alias("add_to_cart_over_merchant_count"),
    )


def rating_daily(events: DataFrame) -> DataFrame:
    """Rating rows stamped with a UTC instant."""
    e = _events_local(events).where(F.col("event_type") == "purchase")
    return e.select(
        F.col("utc_ts").alias("created_timestamp"), "restaurant_uuid",
        (F.col("event_id") % 9 + 1).alias("rating_count"),
        (F.col("event_id") % 5 + 1).cast("double").alias("average_restaurant_rating"),
        (F.col("user_id") % 5 + 1).cast("double").alias("restaurant_rating"),
    )


def impression_daily(events: DataFrame) -> DataFrame:
    """A10: impression rows."""
    e = _events_local(events).where(F.col("event_type").isin("view", "error"))
    eid = F.col("event_id")
    return e.select(
        F.col("local_date").alias("summary_data_date"), "restaurant_uuid",
        (eid % 11).alias("Food_shuffle_impression_count"),
        (eid % 13).alias("Food_search_impression_count"),
        (eid % 7).alias("Food_suggestion_impression_count"),
        (eid % 11 + eid % 13 + eid % 7).alias("Food_total_impression_count"),
    )


def profile(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """A1: restaurant profile."""
    s = (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
                 .join(region, F.col("n_regionkey") == region.r_regionkey, "left"))
    k = F.col("s_suppkey")
    cuisine = (F.when(k % 4 == 0, "Indonesian").when(k % 4 == 1, "Chinese")
                .when(k % 4 == 2, "Japanese").otherwise("Western"))
    return s.select(
        k.alias("restaurant_id"),
        F.concat(F.lit("uuid-"), k).alias("restaurant_uuid"),
        F.col("n_name").alias("service_area_name"),
        F.concat(F.lit("ENT-"), k % 50).alias("sf_entity_id"),
        (k % 10).alias("brand_id"),
        F.concat(F.lit("Brand "), k % 10).alias("brand_name"),
        F.col("s_name").alias("restaurant_name"),
        cuisine.alias("primary_cuisine_name"),
        F.concat(F.lit("Parent "), k % 20).alias("sf_parent_entity_name"),
        F.when(F.col("n_regionkey") == 1, "ENTERPRISE").otherwise("SME").alias("classification_type_name"),
        F.col("r_name").alias("general_group_name"),
        k.alias("merchant_platform_outlet_id"),
        (F.col("s_nationkey") * 10 + k % 3).cast("bigint").alias("location_s2id_14"),
    )


def universe(supplier: DataFrame) -> DataFrame:
    """A2: outlet universe with sales owner; suppliers with a negative
    balance are not (yet) in it, so the LEFT JOIN leaves NULL owners."""
    k = F.col("s_suppkey")
    return supplier.where(F.col("s_acctbal") >= 0).select(
        k.alias("Food_id"),
        F.concat(F.lit("SC-"), F.col("s_nationkey")).alias("sales_code"),
        F.concat(F.lit("Sales team "), F.col("s_nationkey") % 5).alias("sales_name"),
    )


def geo(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Three geo cells per nation."""
    cells = nation.select("n_nationkey", "n_name", "n_regionkey",
                          F.explode(F.sequence(F.lit(0), F.lit(2))).alias("cell"))
    return cells.join(region, cells.n_regionkey == region.r_regionkey, "left").select(
        (F.col("n_nationkey") * 10 + F.col("cell")).cast("bigint").alias("location_s2id_14"),
        F.concat(F.col("n_name"), F.lit("-D"), F.col("cell")).alias("subdistrict_name"),
        F.concat(F.col("n_name"), F.lit("-R"), F.col("cell") % 2).alias("regency_name"),
        F.col("r_name").alias("sales_region_name"),
    )


def _versions(orders: DataFrame) -> DataFrame:
    """Each order opens a version of its customer's records; the customer's
    next order (by date, then order key) closes it; the last stays open.

    Orders of one day share one effective instant, so within a day every
    version but the last closes at its own start (zero length), and the
    day's last version closes at the customer's next order day. That needs
    only a per-(customer, day) aggregate and a chain over distinct order
    days, never one customer's whole order history in one task.
    """
    eff = F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(18))
    rows = orders.select("o_orderkey", "o_custkey", "o_orderdate", eff.alias("effective_timestamp"))
    days = rows.groupBy("o_custkey", "o_orderdate").agg(
        F.max("o_orderkey").alias("_last_key"),
        F.first("effective_timestamp").alias("_day_eff"))
    chain = Window.partitionBy("o_custkey").orderBy("o_orderdate")
    days = days.select("o_custkey", "o_orderdate", "_last_key",
                       F.lead("_day_eff").over(chain).alias("_next_day_eff"))
    return (rows.join(days, ["o_custkey", "o_orderdate"], "inner")
                .withColumn("expired_timestamp",
                            F.when(F.col("o_orderkey") == F.col("_last_key"), F.col("_next_day_eff"))
                             .otherwise(F.col("effective_timestamp")))
                .drop("_last_key", "_next_day_eff"))


def _flag(key: Column, mod: int, true_at: int, null_at: int) -> Column:
    return (F.when(key % mod == true_at, F.lit(True))
             .when(key % mod == null_at, F.lit(None).cast("boolean"))
             .otherwise(F.lit(False)))


def dim_outlet(orders: DataFrame) -> DataFrame:
    """Outlet history; the entity of an outlet changes per version."""
    v = _versions(orders)
    k = F.col("o_orderkey")
    return v.select(
        F.concat(F.lit("SO-"), F.col("o_custkey")).alias("sf_outlet_id"),
        F.col("o_custkey").alias("outlet_id"),
        F.concat(F.lit("ENT-"), k % 50).alias("sf_account_id"),
        "effective_timestamp", "expired_timestamp",
        _flag(k, 7, 0, 1).alias("deleted_flag"),
        _flag(k, 11, 0, 1).alias("duplicate_flag"),
    )


def dim_account(orders: DataFrame) -> DataFrame:
    """Account history in three roles (product outlet, billing group, entity)."""
    v = _versions(orders)
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    none = F.lit(None).cast("string")
    product_outlet = v.select(
        F.concat(F.lit("PO-"), k).alias("sf_account_id"),
        F.concat(F.lit("SO-"), c).alias("sf_outlet_id"),
        F.concat(F.lit("Outlet "), c).alias("sf_account_name"),
        F.concat(F.lit("ENT-"), k % 50).alias("parent_id"),
        none.alias("parent_entity_detail_name"),
        F.when(k % 5 == 0, "Product Outlet Mart").otherwise("Product Outlet Food").alias("record_type_name_detail"),
        F.lit("FOOD").alias("service_product_list_name"),
        F.when(k % 13 == 0, none).otherwise(F.concat(F.lit("BG-"), c % 30)).alias("billing_group_entity_id"),
        "effective_timestamp", "expired_timestamp",
        _flag(k, 7, 3, 4).alias("deleted_flag"),
    )
    billing_group = v.select(
        F.concat(F.lit("BG-"), c).alias("sf_account_id"),
        none.alias("sf_outlet_id"),
        F.concat(F.lit("Billing group "), c).alias("sf_account_name"),
        none.alias("parent_id"),
        F.concat(F.lit("BG parent "), k).alias("parent_entity_detail_name"),
        F.lit("Billing Group").alias("record_type_name_detail"),
        F.lit("FOOD").alias("service_product_list_name"),
        none.alias("billing_group_entity_id"),
        "effective_timestamp", "expired_timestamp",
        _flag(k, 7, 5, 6).alias("deleted_flag"),
    )
    entity = v.select(
        F.concat(F.lit("ENT-"), c).alias("sf_account_id"),
        none.alias("sf_outlet_id"),
        F.concat(F.lit("Entity "), c, F.lit(" rev "), k).alias("sf_account_name"),
        none.alias("parent_id"),
        none.alias("parent_entity_detail_name"),
        F.lit("Entity").alias("record_type_name_detail"),
        F.lit("GO-FOOD").alias("service_product_list_name"),
        none.alias("billing_group_entity_id"),
        "effective_timestamp", "expired_timestamp",
        _flag(k, 7, 5, 6).alias("deleted_flag"),
    )
    return product_outlet.unionByName(billing_group).unionByName(entity)


def lines_of_window(orders: DataFrame, lineitem: DataFrame, window: MonthWindow, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The lines whose order key has an order in the window, all columns kept.

    A join with a month's orders needs no other lines, and whoever joins on the order number
    (order key and supplier) meets no others: the lines are dropped in their scan instead of
    being shuffled with every join. Only the month's distinct keys are broadcast, and only when
    counted within the bound; beyond it the lines stay as they are and the joins shuffle them.
    """
    keys = orders.where(in_local_window(F.col("o_orderdate"), window)).select(F.col("o_orderkey").alias("_w_key")).distinct()
    if keys.count() > max_rows:
        return lineitem
    return lineitem.join(F.broadcast(keys), F.col("l_orderkey") == F.col("_w_key"), "left_semi")


def tpch_sources(spark: SparkSession, sf_dir: str, second_bookings: bool = False, window: MonthWindow | None = None) -> LazySources:
    """The mart inputs over the driver tables of ``sf_dir`` (built on use), A5 if asked for.

    ``window`` is for queries that join everything made of order lines with the bookings of that window,
    by date or by order number: these inputs then leave out lines of other orders (:func:`lines_of_window`).
    """
    tables: dict[str, DataFrame] = {}

    def t(name: str) -> DataFrame:
        if name not in tables:
            if name == "lines":
                tables[name] = t("lineitem") if window is None else lines_of_window(t("orders"), t("lineitem"), window)
            else:
                tables[name] = read(spark, sf_dir, name)
        return tables[name]

    src: LazySources

    def lazy(name: str):
        return lambda: getattr(src, name)

    src = LazySources({
        "bookings": lambda: bookings(t("orders"), t("lines")),
        "booking_cm": lambda: booking_cm(t("orders"), t("lines")),
        **({"econ_bookings": lambda: econ_bookings(t("orders"), t("lines"))} if second_bookings else {}),
        "promo_tx": lambda: promo_tx(t("orders"), t("lines")),
        "spine": lambda: spine_daily(lazy("bookings")()),
        "ads": lambda: ads_daily(t("events")),
        "funnel": lambda: funnel_daily(t("events")),
        "rating": lambda: rating_daily(t("events")),
        "impressions": lambda: impression_daily(t("events")),
        "profile": lambda: profile(t("supplier"), t("nation"), t("region")),
        "universe": lambda: universe(t("supplier")),
        "geo": lambda: geo(t("nation"), t("region")),
        "dim_outlet": lambda: dim_outlet(t("orders")),
        "dim_account": lambda: dim_account(t("orders")),
        "fx": lambda: fx_table(spark, FX_RATES),
    })
    return src
