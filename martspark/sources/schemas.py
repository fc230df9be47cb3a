"""Explicit schemas of the mart inputs (names as the marts read them).

The reference declares no DDL; names come from use, types are chosen here:
ids as the adapters produce them, money as exact decimals, instants as
TIMESTAMP_NTZ holding the UTC wall clock, local dates as DATE.
These are used to build hand-made frames in tests and to check adapters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

AMOUNT = T.DecimalType(18, 4)
GMV = T.DecimalType(18, 2)
RPL_STRUCT = T.StructType([
    T.StructField("budget_entity_name", T.StringType()),
    T.StructField("program_name", T.StringType()),
    T.StructField("program_group_name", T.StringType()),
    T.StructField("Food_spend_amount", AMOUNT),
])

RPL_AMOUNT_COLUMNS = [
    "estimated_rpl_total_amount",
    "rpl_voucher_amount",
    "rpl_markdown_delivery_subsidy_amount",
    "rpl_markdown_direct_discount_amount",
    "rpl_subscription_amount",
    "rpl_markdown_gopay_coins_issuance_amount",
    "rpl_gopay_coins_redemption_amount",
    "rpl_mission_cashback_amount",
    "rpl_invoice_adjustment_amount",
    "rpl_dynamic_platform_fee_discount_amount",
    "economical_delivery_discount_amount",
]

BOOKINGS = T.StructType(
    [
        T.StructField("order_no", T.StringType()),
        T.StructField("restaurant_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("created_timestamp", T.TimestampNTZType()),
        T.StructField("jakarta_booking_created_date", T.DateType()),
        T.StructField("status_id", T.StringType()),
        T.StructField("Food_mode_name", T.StringType()),
        T.StructField("restaurant_accepted_timestamp", T.TimestampNTZType()),
        T.StructField("picked_up_timestamp", T.TimestampNTZType()),
        T.StructField("booking_to_closed_duration_in_second", T.DoubleType()),
        T.StructField("eta_in_minute", T.DoubleType()),
        T.StructField("actual_gmv_amount", GMV),
        T.StructField("normalized_gmv_amount", GMV),
        T.StructField("sku_promotion_count", T.LongType()),
        T.StructField("total_campaign_discount_cart_amount", AMOUNT),
        T.StructField("voucher_discount_amount", AMOUNT),
        T.StructField("food_pas_flag", T.BooleanType()),
    ]
    + [T.StructField(c, AMOUNT) for c in RPL_AMOUNT_COLUMNS]
    + [T.StructField("rpl_detail_list", T.ArrayType(RPL_STRUCT))]
)

ECONOMICS_AMOUNTS = [
    "cm_amount",
    "cost_of_revenue_amount",
    "gtv_amount",
    "gross_take_preoffset_amount",
    "merchant_commission_amount",
    "mfp_markdown_amount",
    "net_rpl_amount",
    "gross_rpl_amount",
    "gmv_amount",
]
BOOKING_CM = T.StructType(
    [T.StructField("order_no", T.StringType()), T.StructField("booking_date", T.DateType())]
    + [T.StructField(c, AMOUNT) for c in ECONOMICS_AMOUNTS]
)

PROFILE = T.StructType([
    T.StructField("restaurant_id", T.LongType()),
    T.StructField("restaurant_uuid", T.StringType()),
    T.StructField("service_area_name", T.StringType()),
    T.StructField("sf_entity_id", T.StringType()),
    T.StructField("brand_id", T.LongType()),
    T.StructField("brand_name", T.StringType()),
    T.StructField("restaurant_name", T.StringType()),
    T.StructField("primary_cuisine_name", T.StringType()),
    T.StructField("sf_parent_entity_name", T.StringType()),
    T.StructField("classification_type_name", T.StringType()),
    T.StructField("general_group_name", T.StringType()),
    T.StructField("merchant_platform_outlet_id", T.LongType()),
    T.StructField("location_s2id_14", T.LongType()),
])

UNIVERSE = T.StructType([
    T.StructField("Food_id", T.LongType()),
    T.StructField("sales_code", T.StringType()),
    T.StructField("sales_name", T.StringType()),
])

GEO = T.StructType([
    T.StructField("location_s2id_14", T.LongType()),
    T.StructField("subdistrict_name", T.StringType()),
    T.StructField("regency_name", T.StringType()),
    T.StructField("sales_region_name", T.StringType()),
])

HISTORY_COMMON = [
    T.StructField("effective_timestamp", T.TimestampNTZType()),
    T.StructField("expired_timestamp", T.TimestampNTZType()),
    T.StructField("deleted_flag", T.BooleanType()),
]
DIM_OUTLET = T.StructType([
    T.StructField("sf_outlet_id", T.StringType()),
    T.StructField("outlet_id", T.LongType()),
    T.StructField("sf_account_id", T.StringType()),
    *HISTORY_COMMON,
    T.StructField("duplicate_flag", T.BooleanType()),
])
DIM_ACCOUNT = T.StructType([
    T.StructField("sf_account_id", T.StringType()),
    T.StructField("sf_outlet_id", T.StringType()),
    T.StructField("sf_account_name", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("parent_entity_detail_name", T.StringType()),
    T.StructField("record_type_name_detail", T.StringType()),
    T.StructField("service_product_list_name", T.StringType()),
    T.StructField("billing_group_entity_id", T.StringType()),
    *HISTORY_COMMON,
])

ADS_DAILY = T.StructType([
    T.StructField("jakarta_data_date", T.DateType()),
    T.StructField("jakarta_end_date", T.DateType()),
    T.StructField("restaurant_uuid", T.StringType()),
    T.StructField("member_type", T.StringType()),
    T.StructField("inventory_name", T.StringType()),
    T.StructField("sales_channel_name", T.StringType()),
    T.StructField("booked_revenue_amount", GMV),
    T.StructField("billed_revenue_amount", AMOUNT),
    T.StructField("direct_gmv_amount", GMV),
    T.StructField("indirect_gmv_amount", GMV),
    T.StructField("realized_impression_count", T.LongType()),
    T.StructField("realized_click_count", T.LongType()),
    T.StructField("direct_completed_order_count", T.LongType()),
    T.StructField("indirect_completed_order_count", T.LongType()),
    T.StructField("new_user_count", T.LongType()),
    T.StructField("existing_user_count", T.LongType()),
    T.StructField("dormant_user_count", T.LongType()),
])

SPINE_AMOUNTS = [
    "completed_Food_gmv_amount",
    "completed_Food_mfp_markdown_amount",
    "completed_Food_mfp_sku_amount",
    "completed_Food_mfp_voucher_amount",
    "completed_merchant_commission_amount",
    "completed_Food_estimated_rpl_amount",
    "ads_booked_amount",
    "ads_realized_amount",
    "ads_booked_paid_revenue_amount",
    "ads_realized_paid_revenue_amount",
]
SPINE_DAILY = T.StructType(
    [T.StructField("summary_data_date", T.DateType()), T.StructField("Food_id", T.LongType())]
    + [T.StructField(c, AMOUNT) for c in SPINE_AMOUNTS]
    + [T.StructField("completed_Food_order_number", T.LongType()),
       T.StructField("all_Food_order_number", T.LongType())]
)

FUNNEL_DAILY = T.StructType([
    T.StructField("summary_data_date", T.DateType()),
    T.StructField("restaurant_uuid", T.StringType()),
    T.StructField("profile_visit_over_merchant_count", T.LongType()),
    T.StructField("add_to_cart_over_merchant_count", T.LongType()),
])

RATING_DAILY = T.StructType([
    T.StructField("created_timestamp", T.TimestampNTZType()),
    T.StructField("restaurant_uuid", T.StringType()),
    T.StructField("rating_count", T.LongType()),
    T.StructField("average_restaurant_rating", T.DoubleType()),
    T.StructField("restaurant_rating", T.DoubleType()),
])

IMPRESSION_COUNTS = [
    "Food_shuffle_impression_count",
    "Food_search_impression_count",
    "Food_suggestion_impression_count",
    "Food_total_impression_count",
]
IMPRESSION_DAILY = T.StructType(
    [T.StructField("summary_data_date", T.DateType()),
     T.StructField("restaurant_uuid", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in IMPRESSION_COUNTS]
)

PROMO_TX = T.StructType([
    T.StructField("order_no", T.StringType()),
    T.StructField("jakarta_booking_date", T.DateType()),
    T.StructField("item_promotion_burnt_amount", AMOUNT),
    T.StructField("campaign_discount_burnt_amount", AMOUNT),
    T.StructField("voucher_burnt_amount", AMOUNT),
    T.StructField("total_order_burnt_amount", AMOUNT),
    T.StructField("customer_id", T.LongType()),
    T.StructField("restaurant_type", T.StringType()),
    T.StructField("gmv_amount", GMV),
    T.StructField("payment_type", T.StringType()),
])


def check_columns(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Fail early when an input lacks a column the marts read."""
    have = {c.lower() for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in have]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    return df
