"""The query slate: one Spark query per operator group of the survey.

Every query reads the driver tables of ``sf_dir`` through the adapters and
runs the library operators over whole tables. Money columns are exact
decimals inside and leave as DOUBLE (one rounding of an exact value), so
results compare bit-for-bit with the SQL oracle.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martspark.functions import classify
from martspark.functions.calendar import local_date, local_datetime_between_dates, month_of, month_to_date
from martspark.functions.money import with_rate
from martspark.operators import branches as B
from martspark.operators import history as H
from martspark.operators.dims import Enterprise, enriched_dim_as_of, restaurant_dim
from martspark.operators.distinct import distinct_rollup
from martspark.operators.quality import duplicate_keys
from martspark.operators.spine import DAY, RID
from martspark.plans import marts as M
from martspark.plans.session import scratch_dir, tune
from martspark.sources.catalog import Sources
from martspark.sources.tpch import RUN_DATE, _lines, read, tpch_sources

PREV_RUN_DATE = dt.date(1998, 1, 1)
WINDOW = month_to_date(RUN_DATE)

# Driver mapping of the city tiers: three nested lists of nation names.
DRIVER_TIERS = classify.CityTiers(
    tier3=tuple(f"NATION_{i}" for i in range(15)),
    focus=tuple(f"NATION_{i}" for i in range(8)),
    top5=tuple(f"NATION_{i}" for i in (1, 2, 3, 5, 7)),
)


def as_output(df: DataFrame) -> DataFrame:
    """Exact decimals leave as DOUBLE."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def _src(spark: SparkSession, sf_dir: str) -> Sources:
    """Mart inputs over the driver tables of ``sf_dir``, derived in the query itself."""
    return tpch_sources(tune(spark), sf_dir)


def _month(spark: SparkSession, sf_dir: str, run_date: dt.date = RUN_DATE, **options) -> Sources:
    """The same for the marts and their branches, whose order lines all meet bookings of the run date's window."""
    return tpch_sources(tune(spark), sf_dir, window=month_to_date(run_date), **options)


def _ent(src: Sources) -> Enterprise:
    return Enterprise.of(restaurant_dim(src.profile, src.universe))


# ----------------------------------------------------------------------------

def mtd_window_filter(spark, sf_dir):
    s = _month(spark, sf_dir).spine
    return as_output(s.where(WINDOW.contains(F.col("summary_data_date"))).select(
        "summary_data_date", "Food_id", month_of(F.col("summary_data_date")).alias("month_start"),
        "all_Food_order_number", "completed_Food_gmv_amount"))


def local_date_window(spark, sf_dir):
    b = B.bookings_in_window(_month(spark, sf_dir).bookings, WINDOW)
    return as_output(b.groupBy(F.col("jakarta_booking_created_date").alias("booking_date")).agg(
        F.count(F.lit(1)).alias("n_bookings"), F.sum("normalized_gmv_amount").alias("gmv")))


def local_datetime_window_cutoff(spark, sf_dir):
    r = _src(spark, sf_dir).rating
    ts = F.col("created_timestamp")
    r = r.where(B.in_local_window(ts, WINDOW))
    return r.groupBy(local_date(ts).alias("event_date")).agg(
        F.count(F.lit(1)).alias("n_local_date"),
        F.count_if(local_datetime_between_dates(ts, WINDOW)).alias("n_literal_datetime"))


def restaurant_dim_q(spark, sf_dir):
    s = _src(spark, sf_dir)
    return restaurant_dim(s.profile, s.universe)


def restaurant_dim_enriched_q(spark, sf_dir):
    s = _src(spark, sf_dir)
    return enriched_dim_as_of(s.profile, s.universe, s.geo, s.dim_outlet, s.dim_account, WINDOW.end)


def history_as_of(spark, sf_dir):
    return H.outlets_as_of(_src(spark, sf_dir).dim_outlet, WINDOW.end)


def outlet_bridge(spark, sf_dir):
    s = _src(spark, sf_dir)
    return H.outlet_bridge(s.dim_outlet, s.dim_account, WINDOW.end)


def outlet_bridge_literal(spark, sf_dir):
    """The reference's ``UPPER(x) = "Entity"`` never matches: no parent names."""
    s = _src(spark, sf_dir)
    return H.outlet_bridge(s.dim_outlet, s.dim_account, WINDOW.end, H.BridgeRules(entity_type="Entity"))


def outlet_roles(spark, sf_dir):
    """The bridge with all three account roles."""
    s = _src(spark, sf_dir)
    return H.outlet_roles(s.dim_outlet, s.dim_account, WINDOW.end)


def left_join_using(spark, sf_dir):
    s = _src(spark, sf_dir)
    dim = restaurant_dim(s.profile, s.universe).select("restaurant_uuid", "restaurant_id")
    f = s.funnel.where(WINDOW.contains(F.col("summary_data_date")))
    return f.join(dim, ["restaurant_uuid"], "left").select(
        "summary_data_date", "restaurant_uuid", "restaurant_id",
        "profile_visit_over_merchant_count", "add_to_cart_over_merchant_count")


def composite_expression_join(spark, sf_dir):
    s = _month(spark, sf_dir)
    costs = B.cost_split(B.with_economics(s.bookings, s.booking_cm, WINDOW, _ent(s)), s.fx).select(
        F.col("order_no").alias("_c_order"), F.col("booking_date").alias("_c_date"),
        "rpl_overall", "rpl_cofunding")
    b = B.bookings_in_window(s.bookings, WINDOW).select(
        "order_no", "restaurant_id", local_date(F.col("created_timestamp")).alias("booking_date"))
    j = b.join(costs, (F.col("order_no") == F.col("_c_order")) & (F.col("booking_date") == F.col("_c_date")), "left")
    return as_output(j.select("order_no", "restaurant_id", "booking_date", "rpl_overall", "rpl_cofunding"))


def fx_convert_by_year(spark, sf_dir):
    s = _src(spark, sf_dir)
    j = with_rate(s.booking_cm, "booking_date", s.fx)
    return as_output(j.groupBy(F.year("booking_date").alias("year"), "rate").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("gmv_amount").alias("gmv_native"),
        F.sum(F.col("gmv_amount") * F.col("rate")).alias("gmv_converted")))


def join_fanout_check(spark, sf_dir):
    """Booking keys with more than one order line; joining lines to
    bookings on this key would multiply booking measures by ``n_rows``."""
    tune(spark)
    lines = _lines(read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")) \
        .select(F.concat_ws("-", "o_orderkey", "l_suppkey").alias("order_no"))
    return duplicate_keys(lines, ["order_no"])


def unnest_cost_split(spark, sf_dir):
    s = _month(spark, sf_dir)
    return as_output(B.cost_split(B.with_economics(s.bookings, s.booking_cm, WINDOW, _ent(s)), s.fx).select(
        "booking_date", "order_no", "rpl_overall", "abra_cost", "rpl_cofunding"))


def _order_econ(s: Sources, ent: Enterprise) -> DataFrame:
    return B.order_economics_fused(*B.economics_parts(s.bookings, s.booking_cm, WINDOW, ent), s.fx)


def order_economics(spark, sf_dir):
    """J7 as written: J6 aggregated, then joined back on (order, date)."""
    s = _month(spark, sf_dir)
    bc = B.with_economics(s.bookings, s.booking_cm, WINDOW, _ent(s))
    return as_output(B.order_economics(bc, B.cost_split(bc, s.fx)))


def daily_economics(spark, sf_dir):
    s = _month(spark, sf_dir)
    return as_output(B.daily_economics(_order_econ(s, _ent(s)), s.fx))


def kpi_monthly_second_bookings(spark, sf_dir):
    """A5: the KPI mart with costs from the first booking table, modes and economics from the second."""
    return as_output(M.kpi_monthly(_month(spark, sf_dir, second_bookings=True), RUN_DATE))


def sum_distinct_vs_order_distinct(spark, sf_dir):
    s = _month(spark, sf_dir)
    return as_output(B.order_distinct_sum(_order_econ(s, _ent(s)), s.fx))


def paid_ads_daily(spark, sf_dir):
    s = _src(spark, sf_dir)
    return as_output(B.paid_ads_daily(s.ads, WINDOW, _ent(s)))


def daily_order_totals(spark, sf_dir):
    s = _month(spark, sf_dir)
    return as_output(B.daily_order_totals(s.spine, WINDOW, _ent(s)))


def funnel_max_then_sum(spark, sf_dir):
    s = _src(spark, sf_dir)
    return B.funnel_daily(s.funnel, WINDOW, _ent(s))


def fulfilment_ops(spark, sf_dir):
    s = _month(spark, sf_dir)
    return B.fulfilment_ops(s.bookings, WINDOW, _ent(s))


def weighted_rating(spark, sf_dir):
    s = _src(spark, sf_dir)
    return B.weighted_rating(s.rating, WINDOW, _ent(s))


def impressions_distinct(spark, sf_dir):
    s = _src(spark, sf_dir)
    return B.impressions_distinct(s.impressions, WINDOW, _ent(s))


def aov_bands_long(spark, sf_dir):
    s = _month(spark, sf_dir)
    return B.aov_bands_long(s.bookings, WINDOW, _ent(s))


def aov_bands_pivot(spark, sf_dir):
    s = _month(spark, sf_dir)
    return B.aov_bands_pivot(s.bookings, WINDOW, _ent(s))


def promo_class_long(spark, sf_dir):
    s = _month(spark, sf_dir)
    return B.promo_class_long(s.bookings, WINDOW, _ent(s))


def promo_class_pivot(spark, sf_dir):
    s = _month(spark, sf_dir)
    return B.promo_class_pivot(s.bookings, WINDOW, _ent(s))


def city_tiers(spark, sf_dir):
    dim = restaurant_dim_enriched_q(spark, sf_dir)
    g = dim.groupBy("service_area_name").agg(F.count_distinct("restaurant_id").alias("n_restaurants"))
    return g.select("service_area_name", "n_restaurants", *DRIVER_TIERS.columns(F.col("service_area_name")))


def multi_distinct_rollup(spark, sf_dir):
    """E17 in the pre-grouped form on (day, restaurant) without dimensions."""
    s = _month(spark, sf_dir)
    b = B.bookings_in_window(s.bookings, WINDOW)
    c = s.promo_tx.where(WINDOW.contains(F.col("jakarta_booking_date"))).select(
        F.col("order_no").alias("_c_order"), "campaign_discount_burnt_amount", "item_promotion_burnt_amount")
    rows = b.join(c, F.col("order_no") == F.col("_c_order"), "left") \
        .withColumn("booking_date", local_date(F.col("created_timestamp")))
    done = F.col("status_id") == "3"
    md = done & (F.coalesce(F.col("campaign_discount_burnt_amount"), F.lit(0)) > 0)
    out = distinct_rollup(
        rows, ["booking_date", "restaurant_id"], "order_no",
        unit_counts={"trx": done, "total_order": None, "co_from_mfp_markdown": md},
        sums={"food_gmv": F.when(done, F.col("actual_gmv_amount")),
              "sku_promo_burnt": F.when(done, F.col("item_promotion_burnt_amount"))},
        other_distinct={"mau": F.when(done, F.col("customer_id"))},
    )
    return as_output(out.select("booking_date", "restaurant_id", "mau", "trx", "total_order",
                                "co_from_mfp_markdown", "food_gmv", "sku_promo_burnt"))


SPINE_PROBE = [
    "completed_Food_gmv_amount", "cm", "d_mfp_markdown_amount", "realized_paid_click_number",
    "profile_visit", "Food_total_impression_count", "a_0_25k", "a_organic",
    "total_late_delivery_order_number", "rating_count",
]


def _spine(mode: str):
    def run(spark, sf_dir):
        s = _month(spark, sf_dir)
        daily = M.kpi_daily(s, RUN_DATE, mode=mode)
        return as_output(daily.select(
            F.col(DAY).alias("summary_data_date"), F.col(RID).alias("Food_id"),
            F.col("dim__restaurant_name").alias("restaurant_name"), *SPINE_PROBE))
    return run


def month_rollup(spark, sf_dir):
    return as_output(M.kpi_monthly(_month(spark, sf_dir), RUN_DATE, mode="full"))


def kpi_monthly(spark, sf_dir):
    return as_output(M.kpi_monthly(_month(spark, sf_dir), RUN_DATE))


def promo_daily(spark, sf_dir):
    return as_output(M.promo_daily(_month(spark, sf_dir), RUN_DATE, tiers=DRIVER_TIERS))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def refresh_month_replace(spark, sf_dir):
    """December once, then January twice; the target keeps one copy of each."""
    from martspark.streaming.refresh import read_mart, refresh_month
    target = _scratch(spark, "promo_daily")
    for run in (PREV_RUN_DATE, RUN_DATE, RUN_DATE):
        mart = M.with_month(M.promo_daily(_month(spark, sf_dir, run), run, tiers=DRIVER_TIERS), "booking_date")
        refresh_month(mart, target, month_to_date(run).month)
    return as_output(read_mart(spark, target, M.PROMO_COLUMNS + ["booking_month"]))


def refresh_append(spark, sf_dir):
    """The KPI mart appended twice; the month's rows are doubled."""
    from martspark.streaming.refresh import append_month, read_mart
    s = _month(spark, sf_dir)
    target = _scratch(spark, "kpi_monthly")
    for _ in range(2):
        append_month(M.kpi_monthly(s, RUN_DATE), target)
    return as_output(read_mart(spark, target, M.KPI_COLUMNS))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "mtd_window_filter": mtd_window_filter,
    "local_date_window": local_date_window,
    "local_datetime_window_cutoff": local_datetime_window_cutoff,
    "restaurant_dim": restaurant_dim_q,
    "restaurant_dim_enriched": restaurant_dim_enriched_q,
    "history_as_of": history_as_of,
    "outlet_bridge": outlet_bridge,
    "outlet_bridge_literal": outlet_bridge_literal,
    "outlet_roles": outlet_roles,
    "left_join_using": left_join_using,
    "composite_expression_join": composite_expression_join,
    "fx_convert_by_year": fx_convert_by_year,
    "join_fanout_check": join_fanout_check,
    "unnest_cost_split": unnest_cost_split,
    "order_economics": order_economics,
    "daily_economics": daily_economics,
    "paid_ads_daily": paid_ads_daily,
    "daily_order_totals": daily_order_totals,
    "funnel_max_then_sum": funnel_max_then_sum,
    "fulfilment_ops": fulfilment_ops,
    "weighted_rating": weighted_rating,
    "impressions_distinct": impressions_distinct,
    "aov_bands_long": aov_bands_long,
    "aov_bands_pivot": aov_bands_pivot,
    "promo_class_long": promo_class_long,
    "promo_class_pivot": promo_class_pivot,
    "city_tiers": city_tiers,
    "sum_distinct_vs_order_distinct": sum_distinct_vs_order_distinct,
    "multi_distinct_rollup": multi_distinct_rollup,
    "spine_left_join": _spine("left"),
    "spine_full_join_literal": _spine("literal"),
    "spine_full_join_coalesced": _spine("full"),
    "month_rollup": month_rollup,
    "kpi_monthly": kpi_monthly,
    "kpi_monthly_second_bookings": kpi_monthly_second_bookings,
    "promo_daily": promo_daily,
    "refresh_month_replace": refresh_month_replace,
    "refresh_append": refresh_append,
}
