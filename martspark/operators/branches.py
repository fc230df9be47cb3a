"""Daily branches of the KPI mart (J6-J16), one function each.

Every branch is filtered to the month-to-date window with literal bounds
(pushable), restricted to enterprise restaurants through the prepared
lookup (a broadcast semi/inner join when its size is proven small), and
aggregated to (day, restaurant) *before* any join with other branches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martspark.functions import classify
from martspark.functions import constants as K
from martspark.functions.calendar import (
    DEFAULT_TZ, MonthWindow, in_local_window, local_date, local_datetime_between_dates)
from martspark.functions.money import FxRates, with_rate
from martspark.operators.dims import Enterprise
from martspark.operators.distinct import per_value
from martspark.plans.joins import null_safe_join
from martspark.sources.layout import in_window_partitions
from martspark.sources.schemas import ECONOMICS_AMOUNTS

# FIXED VALUES: output names and their source columns, in the marts' positional order.
ECON_MEASURES = [
    ("cm", "cm_amount"),
    ("cor", "cost_of_revenue_amount"),
    ("gt_preoffset", "gross_take_preoffset_amount"),
    ("gtv", "gtv_amount"),
    ("net_rpl", "net_rpl_amount"),
    ("mc", "merchant_commission_amount"),
    ("gross_rpl", "gross_rpl_amount"),
    ("mfp_md", "mfp_markdown_amount"),
]

ADS_PAID_SUMS = [
    ("booked_paid_revenue_amount", "booked_revenue_amount"),
    ("realized_paid_revenue_amount", "billed_revenue_amount"),
    ("realized_paid_impression_number", "realized_impression_count"),
    ("realized_paid_click_number", "realized_click_count"),
    ("realized_paid_direct_gmv_amount", "direct_gmv_amount"),
    ("realized_paid_direct_co_number", "direct_completed_order_count"),
    ("realized_paid_indirect_gmv_amount", "indirect_gmv_amount"),
    ("realized_paid_indirect_co_number", "indirect_completed_order_count"),
    ("realized_paid_new_user_count", "new_user_count"),
    ("realized_paid_existing_user_count", "existing_user_count"),
    ("realized_paid_dormant_user_count", "dormant_user_count"),
]


def _completed() -> Column:
    return F.col("status_id") == K.COMPLETED_STATUS


def bookings_in_window(bookings: DataFrame, window: MonthWindow, tz: str = DEFAULT_TZ) -> DataFrame:
    """C2 on bookings: local booking date in the window, as a UTC range.

    Of bookings stored by local date only the window's partitions are read.
    """
    return bookings.where(in_window_partitions(bookings, window, tz)
                          & in_local_window(F.col("created_timestamp"), window, tz))


# --------------------------------------------------------------------------
# J6-J8 economics
# --------------------------------------------------------------------------

def economics_parts(bookings: DataFrame, booking_cm: DataFrame, window: MonthWindow, ent: Enterprise,
                    tz: str = DEFAULT_TZ, prune: bool = False) -> tuple[DataFrame, DataFrame]:
    """Window + enterprise bookings with their economics row: those with an order number, joined, and the others.

    The join's result is hash-partitioned on ``order_no``, which already clusters
    J6's (date, order) aggregate; over tables bucketed by it nothing is
    shuffled. Bookings without an order number match no economics: they stay
    out of the join, where all of them would meet in one task.

    ``prune`` reads only economics between the month's smallest and largest order number, found
    by one job over that column of the month (two values come to the driver; as a
    subquery they would not reach Parquet). Row groups outside are skipped, as stored economics
    are sorted by it. No date limits them.
    """
    b = ent.restrict(bookings_in_window(bookings, window, tz)).select(
        "order_no", "restaurant_id", "created_timestamp", "Food_mode_name", "rpl_detail_list")
    cm = booking_cm.select(F.col("order_no").alias("_cm_order"), F.col("booking_date").alias("_cm_date"),
                           *ECONOMICS_AMOUNTS)
    if prune:
        lo, hi = bookings_in_window(bookings, window, tz).agg(F.min("order_no"), F.max("order_no")).first()
        cm = cm.where(F.col("_cm_order").between(F.lit(lo), F.lit(hi)))
    day = local_date(F.col("created_timestamp"), tz)
    known = (b.where(F.col("order_no").isNotNull())
              .join(cm, F.col("order_no") == F.col("_cm_order"), "left").withColumn("booking_date", day))
    types = dict(cm.dtypes)
    unknown = (b.where(F.col("order_no").isNull())
                .select("*", *[F.lit(None).cast(types[c]).alias(c) for c in cm.columns]).withColumn("booking_date", day))
    return known, unknown


def with_economics(bookings: DataFrame, booking_cm: DataFrame, window: MonthWindow,
                   ent: Enterprise, tz: str = DEFAULT_TZ) -> DataFrame:
    """Window + enterprise bookings LEFT JOIN their economics row on ``order_no``. Shared by J6 and J7."""
    known, unknown = economics_parts(bookings, booking_cm, window, ent, tz)
    return known.unionByName(unknown)


def cost_split(bc: DataFrame, fx: FxRates | DataFrame) -> DataFrame:
    """Unnest the promo cost list and split it three ways, converted once.

    ``bc`` is :func:`with_economics`. Inner UNNEST (D8): a booking with an
    empty or NULL list yields no row. The FX year comes from the economics
    row's booking date, as in the reference; sums are NULL when nothing
    matches (E8).
    """
    rows = bc.select("order_no", "booking_date", "_cm_date", F.inline("rpl_detail_list"))
    rows = with_rate(rows, "_cm_date", fx)
    spend = F.col("Food_spend_amount") * F.col("rate")
    return rows.groupBy("booking_date", "order_no").agg(
        F.sum(F.when(F.col("budget_entity_name") == K.RPL_BUDGET_ENTITY, spend)).alias("rpl_overall"),
        F.sum(F.when(F.col("program_name").isin(K.RPL_PROGRAM), spend)).alias("abra_cost"),
        F.sum(F.when(F.col("program_group_name").isin(K.RPL_PROGRAM_GROUP), spend)).alias("rpl_cofunding"),
    )


def order_economics(bc: DataFrame, costs: DataFrame) -> DataFrame:
    """Delivery bookings with economics and cost split, DISTINCT.

    ``Food_mode_name NOT IN (pickup)`` drops NULL modes as SQL does (the
    filter is on the bookings side of a left join, so it commutes with it).
    The cost split joins on (order, local date): the date is a materialised
    column, so the join is a plain two-column equi-join.
    """
    b = bc.where(~F.col("Food_mode_name").isin(K.PICKUP_MODE))
    c = costs.select(F.col("order_no").alias("_c_order"), F.col("booking_date").alias("_c_date"),
                     F.col("rpl_overall").alias("akab_rpl_overall"), "rpl_cofunding", "abra_cost")
    j = b.join(c, (F.col("order_no") == F.col("_c_order")) & (F.col("booking_date") == F.col("_c_date")), "left")
    return j.select(
        "booking_date", "restaurant_id", F.col("_cm_order").alias("order_no"),
        "cm_amount", "cost_of_revenue_amount", "gtv_amount", "gross_take_preoffset_amount",
        "merchant_commission_amount", "mfp_markdown_amount", "net_rpl_amount", "gross_rpl_amount",
        "akab_rpl_overall", "rpl_cofunding", "abra_cost", "gmv_amount",
    ).distinct()


def order_economics_fused(known: DataFrame, unknown: DataFrame, fx: FxRates | DataFrame) -> DataFrame:
    """J6 + J7 in one pass over the two parts of :func:`economics_parts` (same rows as
    ``order_economics(bc, cost_split(bc, fx))`` over their union).

    The three cost shares are summed inside each booking's list with
    higher-order functions (``filter`` + ``aggregate``), NULL when no element
    matches, as ``SUM(CASE ... END)`` over the unnested rows would be; a
    window over (order, local date) then adds them across the booking's
    rows, which is exactly what the (order, date) join of J6 back to the
    bookings attaches. No explode, no second aggregate, no join back; the
    window reuses the join's ``order_no`` partitioning (no shuffle).
    """
    rows = with_rate(known, "_cm_date", fx)
    acc_type = "decimal(38,8)"

    def share(pred) -> Column:
        # SUM skips NULL amounts, so they are no hits.
        hits = F.filter("rpl_detail_list", lambda x: pred(x) & x["Food_spend_amount"].isNotNull())
        total = F.aggregate(hits, F.lit(0).cast(acc_type),
                            lambda acc, x: (acc + x["Food_spend_amount"] * F.col("rate")).cast(acc_type))
        return F.when(F.size(hits) > 0, total)

    per_booking = Window.partitionBy("order_no", "booking_date")
    shares = {
        "akab_rpl_overall": share(lambda x: x["budget_entity_name"] == K.RPL_BUDGET_ENTITY),
        "abra_cost": share(lambda x: x["program_name"].isin(K.RPL_PROGRAM)),
        "rpl_cofunding": share(lambda x: x["program_group_name"].isin(K.RPL_PROGRAM_GROUP)),
    }
    j = rows.select("*", *[F.sum(v).over(per_booking).alias(k) for k, v in shares.items()])
    # A NULL order number matches no cost row (the join back is on the order).
    types = dict(j.dtypes)
    j = j.drop("rate").unionByName(unknown.select("*", *[F.lit(None).cast(types[k]).alias(k) for k in shares]))
    j = j.where(~F.col("Food_mode_name").isin(K.PICKUP_MODE))
    return j.select(
        "booking_date", "restaurant_id", F.col("_cm_order").alias("order_no"),
        "cm_amount", "cost_of_revenue_amount", "gtv_amount", "gross_take_preoffset_amount",
        "merchant_commission_amount", "mfp_markdown_amount", "net_rpl_amount", "gross_rpl_amount",
        "akab_rpl_overall", "rpl_cofunding", "abra_cost", "gmv_amount",
    ).distinct()


def daily_economics(order_econ: DataFrame, fx: FxRates | DataFrame) -> DataFrame:
    """13 measures per (day, restaurant).

    Amounts are converted with the year's rate and summed null-safe; the
    cost-split sums were converted in J6 and are summed as they are
    (nullable, E8). ``gmv_mfp_non_sku`` keeps the reference's SUM(DISTINCT):
    two orders with equal converted GMV count once (see
    :func:`order_distinct_sum` for the per-order form).
    """
    rate = F.col("rate")
    md = F.col("mfp_markdown_amount") > 0
    j = with_rate(order_econ, "booking_date", fx).withColumns({
        "_md_order": F.when(md, F.col("order_no")), "_md_amount": F.when(md, F.col("gmv_amount") * rate)})
    # Sums and orders by (group, order), amounts by (group, amount): both combine before
    # their shuffle, and both read the one shuffle of the DISTINCT above.
    keys = ["booking_date", "restaurant_id"]
    sums = {**{name: F.coalesce(F.col(src) * rate, F.lit(0)) for name, src in ECON_MEASURES},
            **{name: F.col(name) for name in ("akab_rpl_overall", "rpl_cofunding", "abra_cost")}}
    by_order = j.groupBy(*keys, "_md_order").agg(*[F.sum(e).alias(f"_s_{n}") for n, e in sums.items()])
    out = by_order.groupBy(*keys).agg(F.count("_md_order").alias("co_mfp_non_sku"),
                                      *[F.sum(f"_s_{n}").alias(n) for n in sums])
    amounts = per_value(j, keys, F.col("_md_amount"), F.sum("_value").alias("gmv_mfp_non_sku"))
    return null_safe_join(out, amounts, keys).select(
        *keys, *[name for name, _ in ECON_MEASURES], "co_mfp_non_sku", "akab_rpl_overall", "rpl_cofunding",
        "abra_cost", "gmv_mfp_non_sku")


def order_distinct_sum(order_econ: DataFrame, fx: FxRates | DataFrame) -> DataFrame:
    """E10 side by side: SUM(DISTINCT amount) vs a sum over distinct orders.

    The per-order form de-duplicates on the order key first, so two orders
    with equal amounts both count.
    """
    j = with_rate(order_econ, "booking_date", fx)
    md = F.col("mfp_markdown_amount") > 0
    amount = F.when(md, F.col("gmv_amount") * F.col("rate"))
    keys = ["booking_date", "restaurant_id"]
    j = j.withColumn("_amount", amount)
    by_order = j.groupBy(*keys, "order_no").agg(F.max("_amount").alias("_most"))
    out = by_order.groupBy(*keys).agg(F.sum(F.when(F.col("order_no").isNotNull(), F.col("_most"))).alias("order_distinct_amount"))
    amounts = per_value(j, keys, F.col("_amount"), F.sum("_value").alias("sum_distinct_amount"))
    return null_safe_join(out, amounts, keys).select(*keys, "sum_distinct_amount", "order_distinct_amount")


# --------------------------------------------------------------------------
# J9 paid ads
# --------------------------------------------------------------------------

def paid_ads_daily(ads: DataFrame, window: MonthWindow, ent: Enterprise,
                   keys: tuple[str, ...] = ("jakarta_data_date", "restaurant_uuid", "restaurant_id")) -> DataFrame:
    """Paid campaign performance per (day, restaurant uuid, restaurant).

    ``keys`` may drop the uuid: every measure is a sum of non-NULL terms,
    so summing straight to (day, restaurant) equals re-summing the uuid
    rows (what the spine join needs, without a second aggregate).

    Filters: date in window, member type not 'shadow' (NULL dropped, C7),
    campaign still live at window start (C14), channel class kept (C13),
    paid members only (C10). E7 sums with ELSE 0; E6 sums per inventory.
    """
    chan = F.lower(classify.channel_class(F.col("sales_channel_name")))
    paid = F.col("member_type").isin(K.PAID_MEMBER_TYPES)
    a = ads.where(
        window.contains(F.col("jakarta_data_date"))
        & (F.lower(F.col("member_type")) != K.EXCLUDED_MEMBER_TYPE)
        & (F.col("jakarta_end_date") >= F.lit(window.start))
        & chan.isin(K.CHANNELS_KEPT)
        & paid)
    a = ent.by_uuid(a)
    return a.groupBy(*keys).agg(
        F.sum("booked_revenue_amount").alias("booked_revenue_amount"),
        F.sum("billed_revenue_amount").alias("realized_revenue_amount"),
        *[F.sum(F.when(paid, F.col(src)).otherwise(F.lit(0))).alias(name) for name, src in ADS_PAID_SUMS],
        *[F.coalesce(F.sum(F.coalesce(
            F.when(paid & (F.col("inventory_name") == inv), F.col("billed_revenue_amount")).otherwise(F.lit(0)),
            F.lit(0))), F.lit(0)).alias(name)
          for inv, name in K.ADS_INVENTORY_COLUMNS],
    )


# --------------------------------------------------------------------------
# J10-J14 single-table branches
# --------------------------------------------------------------------------

def daily_order_totals(spine: DataFrame, window: MonthWindow, ent: Enterprise) -> DataFrame:
    """Per (day, restaurant) markdown and order totals."""
    s = ent.restrict(spine.where(window.contains(F.col("summary_data_date"))), "Food_id")
    return s.groupBy("summary_data_date", "Food_id").agg(
        F.sum("completed_Food_mfp_markdown_amount").alias("completed_Food_mfp_markdown_amount"),
        F.sum("all_Food_order_number").alias("all_Food_order_number"),
    )


def funnel_daily(funnel: DataFrame, window: MonthWindow, ent: Enterprise) -> DataFrame:
    """MAX per (day, uuid, restaurant); the reference's second level
    SUM over the same keys is the identity and is folded away (E13, E14)."""
    f = ent.by_uuid(funnel.where(window.contains(F.col("summary_data_date"))))
    return f.groupBy("summary_data_date", "restaurant_uuid", "restaurant_id").agg(
        F.max("profile_visit_over_merchant_count").alias("profile_visit"),
        F.max("add_to_cart_over_merchant_count").alias("add_to_cart"),
    )


def fulfilment_ops(bookings: DataFrame, window: MonthWindow, ent: Enterprise,
                   tz: str = DEFAULT_TZ) -> DataFrame:
    """Preparation minutes, completion seconds, ETA and late orders.

    Whole minutes truncate toward zero (I8). Late = completion minutes
    (fractional, I20) above ETA + 5 (C20, E18).
    """
    b = ent.restrict(bookings_in_window(bookings, window, tz).where(_completed()))
    done = _completed()
    prep = F.expr("timestampdiff(MINUTE, restaurant_accepted_timestamp, picked_up_timestamp)")
    late = done & ((F.col("booking_to_closed_duration_in_second") / 60)
                   > (F.col("eta_in_minute") + K.LATE_MARGIN_MINUTES))
    return b.groupBy("jakarta_booking_created_date", "restaurant_id").agg(
        F.sum(F.when(done, prep)).alias("total_food_preparation_time_in_minute"),
        F.sum(F.when(done, F.col("booking_to_closed_duration_in_second"))).alias("total_completion_time_in_second"),
        F.sum(F.when(done, F.col("eta_in_minute"))).alias("total_eta_in_minute"),
        F.count_distinct(F.when(late, F.col("order_no"))).alias("total_late_delivery_order_number"),
    )


def weighted_rating(rating: DataFrame, window: MonthWindow, ent: Enterprise,
                    literal_cutoff: bool = False, tz: str = DEFAULT_TZ) -> DataFrame:
    """Rating sums weighted by count, per (local day, restaurant).

    Default window is the local *date* (repair 12); ``literal_cutoff``
    reproduces ``DATETIME BETWEEN date AND date`` which ends at 00:00 of the
    last day (C3).
    """
    ts = F.col("created_timestamp")
    cond = (local_datetime_between_dates(ts, window, tz) if literal_cutoff
            else in_local_window(ts, window, tz))
    r = ent.by_uuid(rating.where(cond)).select(
        local_date(ts, tz).alias("event_date"), "restaurant_id",
        (F.col("rating_count") * F.col("average_restaurant_rating")).alias("original_rating_aggregated"),
        (F.col("rating_count") * F.col("restaurant_rating")).alias("app_rating_aggregated"),
        "rating_count")
    return r.groupBy("event_date", "restaurant_id").agg(
        F.sum("original_rating_aggregated").alias("rating_original"),
        F.sum("app_rating_aggregated").alias("rating_app"),
        F.sum("rating_count").alias("rating_count"),
    )


def impressions_distinct(impressions: DataFrame, window: MonthWindow, ent: Enterprise) -> DataFrame:
    """Distinct projection of impression rows (no aggregate)."""
    i = ent.by_uuid(impressions.where(window.contains(F.col("summary_data_date"))))
    return i.select("summary_data_date", "restaurant_uuid", "restaurant_id",
                    "Food_shuffle_impression_count", "Food_search_impression_count",
                    "Food_suggestion_impression_count", "Food_total_impression_count").distinct()


# --------------------------------------------------------------------------
# J15-J16 distributions, long and pivoted wide
# --------------------------------------------------------------------------

def _class_counts(bookings: DataFrame, window: MonthWindow, ent: Enterprise, label: Column,
                  mapping: dict[str, str], out_col: str, tz: str) -> DataFrame:
    b = ent.restrict(bookings_in_window(bookings, window, tz).where(_completed()))
    # The reference's DISTINCT before the count is implied by COUNT(DISTINCT).
    rows = b.select(F.col("jakarta_booking_created_date").alias("summary_data_date"),
                    F.col("restaurant_id").alias("Food_id"),
                    classify.relabel(label, mapping).alias(out_col), "order_no")
    return (rows.groupBy("summary_data_date", "Food_id", out_col)
                .agg(F.count_distinct("order_no").alias("co")))


def aov_bands_long(bookings: DataFrame, window: MonthWindow, ent: Enterprise,
                   tz: str = DEFAULT_TZ) -> DataFrame:
    """J15 long form: completed orders per (day, restaurant, value band)."""
    mapping = dict(zip(K.AOV_LONG_LABELS, K.AOV_SHORT_LABELS))
    return _class_counts(bookings, window, ent, classify.aov_band(F.col("actual_gmv_amount")),
                         mapping, "aov_range_alias", tz)


def promo_class_long(bookings: DataFrame, window: MonthWindow, ent: Enterprise,
                     tz: str = DEFAULT_TZ) -> DataFrame:
    """J16 long form: completed orders per (day, restaurant, promo class)."""
    label = classify.flags_to_class(F.col("sku_promotion_count"),
                                    F.col("total_campaign_discount_cart_amount"),
                                    F.col("voucher_discount_amount"))
    return _class_counts(bookings, window, ent, label, K.PROMO_SHORT_LABELS, "promo_cat", tz)


def completed_orders_daily(bookings: DataFrame, window: MonthWindow, ent: Enterprise,
                           tz: str = DEFAULT_TZ) -> DataFrame:
    """J12 + J15 (pivoted) + J16 (pivoted) in one pass over the month's
    completed enterprise bookings, per (local booking day, restaurant).

    The three branches read the same rows and group by the same key. Rows
    are first grouped by (day, restaurant, order): per-order sums, and for
    every value band and promo class a flag "some row of this order is in
    it" (likewise "late"). A COUNT(DISTINCT order) per class is then a count
    of flags, exact even if an order's rows fall into several classes. Two
    shuffles in all, the first keyed by the order, so a hot restaurant
    spreads; a cell with no order stays NULL, as PIVOT leaves it.
    """
    b = ent.restrict(bookings_in_window(bookings, window, tz).where(_completed()))
    done = _completed()
    prep = F.expr("timestampdiff(MINUTE, restaurant_accepted_timestamp, picked_up_timestamp)")
    late = done & ((F.col("booking_to_closed_duration_in_second") / 60)
                   > (F.col("eta_in_minute") + K.LATE_MARGIN_MINUTES))
    band = classify.aov_band(F.col("actual_gmv_amount"))
    promo = classify.flags_to_class(F.col("sku_promotion_count"),
                                    F.col("total_campaign_discount_cart_amount"),
                                    F.col("voucher_discount_amount"))
    classes = ([(short, band == long) for long, short in zip(K.AOV_LONG_LABELS, K.AOV_SHORT_LABELS)]
               + [(short, promo == long) for long, short in K.PROMO_SHORT_LABELS.items()])
    keys = [F.col("jakarta_booking_created_date").alias("_day"), F.col("restaurant_id").alias("_rid")]
    per_order = b.groupBy(*keys, "order_no").agg(
        F.sum(F.when(done, prep)).alias("_prep"),
        F.sum(F.when(done, F.col("booking_to_closed_duration_in_second"))).alias("_completion"),
        F.sum(F.when(done, F.col("eta_in_minute"))).alias("_eta"),
        F.max(late).alias("_late"),
        *[F.max(cond).alias(f"_in_{name}") for name, cond in classes],
    )
    has_order = F.col("order_no").isNotNull()

    def orders_with(flag: str) -> Column:
        return F.count_if(F.col(flag) & has_order)

    out = per_order.groupBy("_day", "_rid").agg(
        F.sum("_prep").alias("total_food_preparation_time_in_minute"),
        F.sum("_completion").alias("total_completion_time_in_second"),
        F.sum("_eta").alias("total_eta_in_minute"),
        orders_with("_late").alias("total_late_delivery_order_number"),
        *[orders_with(f"_in_{name}").alias(f"_n_{name}") for name, _ in classes],
    )
    return out.select(
        F.col("_day").alias("summary_data_date"), F.col("_rid").alias("Food_id"),
        "total_food_preparation_time_in_minute", "total_completion_time_in_second",
        "total_eta_in_minute", "total_late_delivery_order_number",
        *[F.when(F.col(f"_n_{name}") > 0, F.col(f"_n_{name}")).alias(name) for name, _ in classes],
    )


def pivot_wide(long: DataFrame, col: str, values: list[str]) -> DataFrame:
    """``PIVOT(SUM(co) FOR col IN (values))``.

    Values are always passed, so Spark plans no extra job to find them.
    A group with only unlisted or NULL classes keeps its row, all cells NULL.
    """
    return long.groupBy("summary_data_date", "Food_id").pivot(col, values).agg(F.sum("co"))


def aov_bands_pivot(bookings: DataFrame, window: MonthWindow, ent: Enterprise,
                    tz: str = DEFAULT_TZ) -> DataFrame:
    return pivot_wide(aov_bands_long(bookings, window, ent, tz), "aov_range_alias", K.AOV_SHORT_LABELS)


def promo_class_pivot(bookings: DataFrame, window: MonthWindow, ent: Enterprise,
                      tz: str = DEFAULT_TZ) -> DataFrame:
    return pivot_wide(promo_class_long(bookings, window, ent, tz), "promo_cat",
                      list(K.PROMO_SHORT_LABELS.values()))
