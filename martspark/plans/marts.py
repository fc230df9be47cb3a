"""The two marts: monthly enterprise KPIs (J17) and daily promo performance.

Both return lazy DataFrames with a fixed column order (the sink is
positional, A21). Nothing is collected; the only driver-side actions are
the bounded uniqueness checks and lookup-size checks of the dimension.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martspark.functions import classify
from martspark.functions import constants as K
from martspark.functions.calendar import DEFAULT_TZ, MonthWindow, local_date, month_of, month_to_date
from martspark.functions.money import FxRates
from martspark.operators import branches as B
from martspark.operators.dims import Enterprise, enriched_dim_as_of, restaurant_dim
from martspark.operators.distinct import distinct_rollup
from martspark.operators.history import BridgeRules
from martspark.operators.quality import guarded
from martspark.operators.spine import DAY, RID, SPINE_MODES, Branch, keyed
from martspark.sources.catalog import Sources
from martspark.sources.schemas import RPL_AMOUNT_COLUMNS

# --------------------------------------------------------------------------
# KPI mart
# --------------------------------------------------------------------------

# FIXED VALUES: the mart's column contract, names in positional order.
KPI_KEYS = [
    "booking_month", "saudagar_id", "Food_id", "primary_cuisine_name", "restaurant_name",
    "service_area_name", "brand_id", "brand_name", "sf_entity_id", "sf_parent_entity_name",
    "general_group_name", "classification_type_name",
]

# (output name, input column after the spine join), summed null-safe
KPI_MEASURES: list[tuple[str, str]] = [
    ("gmv", "completed_Food_gmv_amount"),
    ("co", "completed_Food_order_number"),
    ("mfp_markdown", "d_mfp_markdown_amount"),
    ("mfp_sku", "completed_Food_mfp_sku_amount"),
    ("mfp_voucher", "completed_Food_mfp_voucher_amount"),
    ("co_mfp_non_sku", "co_mfp_non_sku"),
    ("total_order", "all_Food_order_number"),
    ("cm", "cm"),
    ("cor", "cor"),
    ("gt", "gt_preoffset"),
    ("gtv", "gtv"),
    ("net_rpl", "net_rpl"),
    ("mc", "mc"),
    ("gross_rpl", "gross_rpl"),
    ("est_mc", "completed_merchant_commission_amount"),
    ("est_rpl", "completed_Food_estimated_rpl_amount"),
    ("fpt_min", "total_food_preparation_time_in_minute"),
    ("completion_time_sec", "total_completion_time_in_second"),
    ("eta_min", "total_eta_in_minute"),
    ("late_delivery_order", "total_late_delivery_order_number"),
    ("total_aggregated_rating", "rating_original"),
    ("total_app_restaurant_rating", "rating_app"),
    ("total_rating_number", "rating_count"),
    ("ads_booked_revenue_amount", "ads_booked_amount"),
    ("ads_realized_revenue_amount", "ads_realized_amount"),
    ("ads_booked_paid_revenue_amount", "ads_booked_paid_revenue_amount"),
    ("ads_realized_paid_revenue_amount", "ads_realized_paid_revenue_amount"),
    *[(name, name) for _, name in K.ADS_INVENTORY_COLUMNS],
    *[(name, name) for name, _ in B.ADS_PAID_SUMS[2:]],
    ("profile_visit", "profile_visit"),
    ("add_to_cart", "add_to_cart"),
    ("Food_shuffle_impression_count", "Food_shuffle_impression_count"),
    ("Food_search_impression_count", "Food_search_impression_count"),
    ("Food_suggestion_impression_count", "Food_suggestion_impression_count"),
    ("Food_total_impression_count", "Food_total_impression_count"),
    *[(name, name) for name in K.AOV_SHORT_LABELS],
    *[(name, name) for name in K.PROMO_SHORT_LABELS.values()],
]
KPI_TAIL = [
    ("akab_rpl_overall", "akab_rpl_overall"),
    ("rpl_cofunding", "rpl_cofunding"),
    ("abra_cost", "abra_cost"),
    ("gmv_from_mfp", "gmv_mfp_non_sku"),
]
KPI_COLUMNS = (KPI_KEYS + [m for m, _ in KPI_MEASURES]
               + ["lates_update_date", "sales_code", "sales_name"] + [m for m, _ in KPI_TAIL])


def kpi_branches(src: Sources, window: MonthWindow, ent: Enterprise,
                 tz: str = DEFAULT_TZ, cache_facts: bool = False,
                 literal_rating_cutoff: bool = False, literal: bool = False, prune: bool = False) -> tuple[Branch, list[Branch]]:
    """The spine and the daily branches, each keyed by (day, restaurant).

    The reference's nine branches map to six inputs here: order totals (J10)
    are the spine's own columns, and fulfilment, value bands and promo
    classes (J12, J15, J16) are one pass. ``literal`` keeps all nine apart
    and the spine as it is. By default every branch reads the bookings with its own pruned columns
    and pushed window range. ``cache_facts`` keeps the month's enterprise
    bookings slice instead (spillable persist), for sources that are costly
    to re-derive; measured slower on parquet inputs, so it is off.
    """
    bk = src.bookings
    if cache_facts:
        bk = ent.restrict(B.bookings_in_window(bk, window, tz)).persist(StorageLevel.MEMORY_AND_DISK)
    fx = FxRates.of(src.fx)
    known, unknown = B.economics_parts(bk, src.booking_cm, window, ent, tz, prune=prune)
    if src.econ_bookings is None:
        orders = B.order_economics_fused(known, unknown, fx)
    else:  # A5: costs from the first booking table, economics from the second
        orders = B.order_economics(B.with_economics(src.econ_bookings, src.booking_cm, window, ent, tz), B.cost_split(known, fx))
    econ = B.daily_economics(orders, fx)
    ads_cols = [n for n, _ in B.ADS_PAID_SUMS[2:]] + [n for _, n in K.ADS_INVENTORY_COLUMNS]
    ads = B.paid_ads_daily(src.ads, window, ent, keys=("jakarta_data_date", "restaurant_id")) \
        .select("jakarta_data_date", "restaurant_id", *ads_cols)
    impr = B.impressions_distinct(src.impressions, window, ent)
    funnel = B.funnel_daily(src.funnel, window, ent)
    # The spine enters like every branch: one row per (day, restaurant).
    # The reference's ``all_order`` branch (J10) is this same spine summed
    # per key and restricted like it, so its measure is the spine's own
    # column; no second read of the spine, no extra join.
    spine_measures = [c for c in src.spine.columns if c not in ("summary_data_date", "Food_id")]
    one_pass = [
        # J12 + J15 + J16 share their rows and key: one pass (same values as
        # fulfilment_ops, aov_bands_pivot and promo_class_pivot joined).
        keyed("hij", B.completed_orders_daily(bk, window, ent, tz), "summary_data_date", "Food_id"),
    ]
    if literal:
        one_pass = [
            keyed("h", B.fulfilment_ops(bk, window, ent, tz), "jakarta_booking_created_date", "restaurant_id"),
            keyed("i", B.aov_bands_pivot(bk, window, ent, tz), "summary_data_date", "Food_id"),
            keyed("j", B.promo_class_pivot(bk, window, ent, tz), "summary_data_date", "Food_id"),
            keyed("d", B.daily_order_totals(src.spine, window, ent).drop("all_Food_order_number"), "summary_data_date", "Food_id",
                  rename={"completed_Food_mfp_markdown_amount": "d_mfp_markdown_amount"}),
        ]
    # Enterprise rows only, through the narrow checked key table, before the
    # spine meets any branch.
    spine = keyed("a", src.spine if literal else ent.restrict(src.spine, "Food_id"), "summary_data_date", "Food_id",
                  resum=spine_measures)
    if not literal:
        spine = Branch("a", spine.df.withColumn("d_mfp_markdown_amount", F.col("completed_Food_mfp_markdown_amount")))
    branches = [
        keyed("b", econ, "booking_date", "restaurant_id"),
        keyed("e", ads, "jakarta_data_date", "restaurant_id"),
        keyed("f", funnel, "summary_data_date", "restaurant_id", resum=["profile_visit", "add_to_cart"]),
        keyed("g", impr, "summary_data_date", "restaurant_id",
              resum=["Food_shuffle_impression_count", "Food_search_impression_count",
                     "Food_suggestion_impression_count", "Food_total_impression_count"]),
        *one_pass,
        keyed("k", B.weighted_rating(src.rating, window, ent, literal_rating_cutoff, tz),
              "event_date", "restaurant_id"),
    ]
    return spine, branches


def kpi_daily(src: Sources, run_date: dt.date, mode: str = "left", tz: str = DEFAULT_TZ,
              check_unique: bool = True, cache_facts: bool = False,
              literal_rating_cutoff: bool = False, ent: Enterprise | None = None,
              prune: bool = False) -> DataFrame:
    """Daily wide rows: spine joined with all branches and the dimension.

    ``mode``: "left" (default, D10), "literal" (the FULL JOIN text, same
    rows) or "full" (repaired full mode). ``literal_rating_cutoff`` keeps the
    reference's ``DATETIME BETWEEN date AND date`` rating window (C3). ``ent``
    is the enterprise slice of a job that wrote it (``Enterprise.of`` without it).
    ``prune`` is that of :func:`branches.economics_parts`, for stored economics.
    """
    window = month_to_date(run_date)
    dim = restaurant_dim(src.profile, src.universe)
    ent = ent or Enterprise.of(dim, check_unique=check_unique)
    literal = mode == "literal"
    spine, branches = kpi_branches(src, window, ent, tz, cache_facts, literal_rating_cutoff, literal, prune)
    return SPINE_MODES[mode](spine, dim if literal else ent.dim, branches, window)


def _zero_sum(col: str) -> Column:
    return F.sum(F.coalesce(F.col(col), F.lit(0)))


def kpi_rollup(daily: DataFrame) -> DataFrame:
    """Day grain to (month, restaurant attributes) with 69 measures."""
    keys = [
        month_of(F.col(DAY)).alias("booking_month"),
        F.col("dim__saudagar_id").alias("saudagar_id"),
        F.col(RID).alias("Food_id"),
        *[F.col(f"dim__{c}").alias(c) for c in KPI_KEYS[3:11]],
        F.col("dim__sales_code").alias("sales_code"),
        F.col("dim__sales_name").alias("sales_name"),
    ]
    aggs = [_zero_sum(src).alias(name) for name, src in KPI_MEASURES]
    aggs.append(F.max(F.col(DAY)).alias("lates_update_date"))
    aggs += [F.sum(src).alias(name) for name, src in KPI_TAIL]
    out = daily.groupBy(*keys).agg(*aggs)
    return out.withColumn("classification_type_name", F.lit(K.ENTERPRISE)).select(*KPI_COLUMNS)


def kpi_monthly(src: Sources, run_date: dt.date, mode: str = "left", tz: str = DEFAULT_TZ,
                check_unique: bool = True, cache_facts: bool = False,
                literal_rating_cutoff: bool = False, ent: Enterprise | None = None,
                prune: bool = False) -> DataFrame:
    """The monthly enterprise KPI mart (83 columns, positional order)."""
    return kpi_rollup(kpi_daily(src, run_date, mode, tz, check_unique, cache_facts, literal_rating_cutoff, ent, prune))


# --------------------------------------------------------------------------
# Promo-project mart
# --------------------------------------------------------------------------

# FIXED VALUES: the mart's column contract, names in positional order.
PROMO_KEYS = [
    "booking_date", "general_group_name", "sf_entity_id", "sf_parent_entity_name", "restaurant_id",
    "restaurant_name", "brand_id", "brand_name", "subdistrict_name", "regency_name",
    "service_area_name", "sales_region_name",
]
PROMO_TIERS = ["city_category", "T3_categories", "top_5_category"]
PROMO_SUMS = [
    ("food_gmv", "actual_gmv_amount"),
    ("sku_promo_burnt", "sku_promo_burnt"),
    ("markdown_mfp_burnt", "markdown_mfp_burnt"),
    ("voucher_mfp_burnt", "voucher_mfp_burnt"),
    ("total_order_mfp_burnt", "total_order_mfp_burnt"),
]
PROMO_MEASURES = (["mau", "trx", "total_order"] + [n for n, _ in PROMO_SUMS] + RPL_AMOUNT_COLUMNS
                  + ["co_from_mfp_markdown", "gmv_from_mfp_markdown"])
PROMO_COLUMNS = PROMO_KEYS + PROMO_TIERS + PROMO_MEASURES


def promo_dimension(src: Sources, run_date: dt.date, rules: BridgeRules = BridgeRules(),
                    tz: str = DEFAULT_TZ, check_unique: bool = True) -> DataFrame:
    """Enterprise slice of the enriched dimension as of the window's end, one row a restaurant.

    A second row fails the run (``check_unique``); nothing is run here. A job
    writes the slice once and hands it to :func:`promo_daily`.
    """
    resto = enriched_dim_as_of(src.profile, src.universe, src.geo, src.dim_outlet,
                               src.dim_account, month_to_date(run_date).end, rules, tz, count_lookups=False)
    resto = resto.where(F.col("classification_type_name") == K.ENTERPRISE).select(
        "restaurant_id", *[c for c in PROMO_KEYS if c not in ("booking_date", "restaurant_id")])
    return guarded(resto, ["restaurant_id"], "enriched restaurant dimension") if check_unique else resto


def promo_rows(src: Sources, run_date: dt.date, rules: BridgeRules = BridgeRules(), tz: str = DEFAULT_TZ,
               check_unique: bool = True, dimension: DataFrame | None = None) -> DataFrame:
    """Bookings of PAS orders in the window with promo burn and restaurant attributes.

    Without a prepared ``dimension`` it is part of the plan; adaptive execution
    broadcasts it when its measured size allows.
    """
    window = month_to_date(run_date)
    resto = promo_dimension(src, run_date, rules, tz, check_unique) if dimension is None else dimension
    resto = resto.withColumnRenamed("restaurant_id", "_r_id")
    a = B.bookings_in_window(src.bookings, window, tz).where(F.col("food_pas_flag").eqNullSafe(True))
    c = src.promo_tx.where(window.contains(F.col("jakarta_booking_date"))).select(
        F.col("order_no").alias("_c_order"),
        F.col("item_promotion_burnt_amount").alias("sku_promo_burnt"),
        F.col("campaign_discount_burnt_amount").alias("markdown_mfp_burnt"),
        F.col("voucher_burnt_amount").alias("voucher_mfp_burnt"),
        F.col("total_order_burnt_amount").alias("total_order_mfp_burnt"))
    # Promo last: an aggregate that reads none of its columns is spared the join.
    j = (a.join(resto, F.col("restaurant_id") == F.col("_r_id"), "inner")
          .join(c, F.col("order_no") == F.col("_c_order"), "left"))
    return j.withColumn("booking_date", local_date(F.col("created_timestamp"), tz))


def promo_daily(src: Sources, run_date: dt.date, tiers: classify.CityTiers = classify.CityTiers(),
                rules: BridgeRules = BridgeRules(), tz: str = DEFAULT_TZ,
                check_unique: bool = True, dimension: DataFrame | None = None) -> DataFrame:
    """Daily promo-project mart, 12 keys + 3 tiers + 21 measures.

    Four distinct counts in one group would make Spark replicate every row
    once per distinct expression (``Expand``). Instead rows are first
    grouped by (keys, order): order counts become plain counts of flags,
    sums are sums of per-order sums. Only ``mau`` (distinct customers)
    needs its own aggregate, which reads the bookings' few columns for it;
    the two small results are joined on the keys (NULL-safe, names may be NULL).
    """
    rows = promo_rows(src, run_date, rules, tz, check_unique, dimension)
    done = F.col("status_id") == K.COMPLETED_STATUS
    md = done & (F.coalesce(F.col("markdown_mfp_burnt"), F.lit(0)) > 0)
    out = distinct_rollup(
        rows, PROMO_KEYS, "order_no",
        unit_counts={"trx": done, "total_order": None, "co_from_mfp_markdown": md},
        sums={**{n: F.when(done, F.col(c)) for n, c in PROMO_SUMS},
              **{c: F.coalesce(F.when(done, F.col(c)), F.lit(0)) for c in RPL_AMOUNT_COLUMNS},
              "gmv_from_mfp_markdown": F.when(md, F.col("normalized_gmv_amount"))},
        other_distinct={"mau": F.when(done, F.col("customer_id"))},
    )
    return out.select(*PROMO_KEYS, *tiers.columns(F.col("service_area_name")), *PROMO_MEASURES)


def promo_daily_direct(src: Sources, run_date: dt.date, tiers: classify.CityTiers = classify.CityTiers(),
                       rules: BridgeRules = BridgeRules(), tz: str = DEFAULT_TZ,
                       check_unique: bool = True) -> DataFrame:
    """J18 in the reference's one-aggregate form (E17: Spark plans an Expand).

    Same result as :func:`promo_daily`; kept for the equivalence test.
    """
    rows = promo_rows(src, run_date, rules, tz, check_unique)
    done = F.col("status_id") == K.COMPLETED_STATUS
    md = done & (F.coalesce(F.col("markdown_mfp_burnt"), F.lit(0)) > 0)
    out = rows.groupBy(*PROMO_KEYS).agg(
        F.count_distinct(F.when(done, F.col("customer_id"))).alias("mau"),
        F.count_distinct(F.when(done, F.col("order_no"))).alias("trx"),
        F.count_distinct(F.col("order_no")).alias("total_order"),
        *[F.sum(F.when(done, F.col(s))).alias(n) for n, s in PROMO_SUMS],
        *[F.sum(F.coalesce(F.when(done, F.col(c)), F.lit(0))).alias(c) for c in RPL_AMOUNT_COLUMNS],
        F.count_distinct(F.when(md, F.col("order_no"))).alias("co_from_mfp_markdown"),
        F.sum(F.when(md, F.col("normalized_gmv_amount"))).alias("gmv_from_mfp_markdown"),
    )
    return out.select(*PROMO_KEYS, *tiers.columns(F.col("service_area_name")), *PROMO_MEASURES)


def with_month(df: DataFrame, date_col: str) -> DataFrame:
    """Add the ``booking_month`` partition column of a daily mart."""
    return df.withColumn("booking_month", month_of(F.col(date_col)))


__all__: Sequence[str] = [
    "KPI_COLUMNS", "PROMO_COLUMNS", "kpi_monthly", "kpi_daily", "kpi_rollup",
    "promo_daily", "promo_daily_direct", "with_month",
]
