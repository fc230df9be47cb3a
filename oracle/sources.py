"""DuckDB text of the driver-table adapters (same mapping as
``martspark.sources.tpch``), as CTEs that every oracle query starts with.

Written independently in plain SQL: joins, GROUP BY, window LEAD for the
history chains, LIST/UNNEST for the nested cost list.
"""

from __future__ import annotations

import datetime as dt

AMOUNT = "DECIMAL(18,4)"
GMV = "DECIMAL(18,2)"

FX_ROWS = [
    (1992, 2000), (1993, 2100), (1994, 2200), (1995, 9500), (1996, 10000),
    (1997, 11000), (1998, 14500), (1999, 15000), (2000, 15500), (2001, 16000),
    (2002, 16500),
]


def local_date(ts: str) -> str:
    return f"CAST({ts} + INTERVAL 7 HOUR AS DATE)"


def _rpl(name: str, cond: str | None, base: str, null_mod: int | None) -> str:
    v = {"disc": "price * disc", "tax": "price * tax", "one_pct": "price * CAST(0.01 AS DECIMAL(3,2))"}[base]
    if cond:
        v = f"CASE WHEN {cond} THEN {v} ELSE 0 END"
    total = f"CAST(SUM({v}) AS {AMOUNT})"
    if null_mod:
        total = f"CASE WHEN o_orderkey % {null_mod} = 0 THEN NULL ELSE {total} END"
    return f"{total} AS {name}"


RPL = [
    ("estimated_rpl_total_amount", None, "disc", None),
    ("rpl_voucher_amount", "l_returnflag = 'R'", "disc", None),
    ("rpl_markdown_delivery_subsidy_amount", "l_linestatus = 'F'", "tax", None),
    ("rpl_markdown_direct_discount_amount", "l_linestatus = 'O'", "disc", None),
    ("rpl_subscription_amount", None, "tax", 4),
    ("rpl_markdown_gopay_coins_issuance_amount", None, "one_pct", None),
    ("rpl_gopay_coins_redemption_amount", "l_returnflag = 'A'", "disc", None),
    ("rpl_mission_cashback_amount", "l_returnflag = 'N'", "tax", None),
    ("rpl_invoice_adjustment_amount", None, "disc", 6),
    ("rpl_dynamic_platform_fee_discount_amount", "l_linestatus = 'F'", "disc", None),
    ("economical_delivery_discount_amount", "l_linestatus = 'O'", "tax", None),
]
RPL_COLUMNS = [r[0] for r in RPL]


def source_ctes() -> str:
    fx = " UNION ALL ".join(f"SELECT {y} AS year, CAST({r} AS DECIMAL(18,4)) AS rate" for y, r in FX_ROWS)
    rpl = ",\n      ".join(_rpl(*r) for r in RPL)
    return f"""
lines AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
         l.l_suppkey, l.l_quantity, l.l_returnflag, l.l_linestatus, l.l_shipdate, l.l_discount, l.l_tax,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(l.l_discount AS DECIMAL(4,2)) AS disc,
         CAST(l.l_tax AS DECIMAL(4,2)) AS tax
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
),
bookings AS (
  SELECT concat(o_orderkey, '-', l_suppkey) AS order_no,
         l_suppkey AS restaurant_id,
         o_custkey AS customer_id,
         o_orderdate AS created_timestamp,
         {local_date('o_orderdate')} AS jakarta_booking_created_date,
         CASE o_orderstatus WHEN 'F' THEN '3' WHEN 'P' THEN '2' ELSE '1' END AS status_id,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'FOOD-PICKUP'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 'FOOD-DELIVERY' END AS Food_mode_name,
         o_orderdate AS restaurant_accepted_timestamp,
         max(l_shipdate) AS picked_up_timestamp,
         CAST(date_sub('second', o_orderdate, max(l_shipdate)) AS DOUBLE) AS booking_to_closed_duration_in_second,
         CAST(max(l_quantity) * 1440 AS DOUBLE) AS eta_in_minute,
         CAST(o_totalprice AS {GMV}) AS actual_gmv_amount,
         CAST(sum(price) AS {GMV}) AS normalized_gmv_amount,
         CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS sku_promotion_count,
         CAST(sum(CASE WHEN l_tax > 0.04 THEN price * tax ELSE 0 END) AS {AMOUNT}) AS total_campaign_discount_cart_amount,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN price * disc ELSE 0 END) AS {AMOUNT}) AS voucher_discount_amount,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 5 <> 1 END AS food_pas_flag,
      {rpl},
         list(struct_pack(
           budget_entity_name := CASE WHEN l_linestatus = 'F' THEN 'AKAB' ELSE 'MERCHANT' END,
           program_name := CASE WHEN l_returnflag = 'A' THEN 'Project Abracadabra' ELSE 'Regular Program' END,
           program_group_name := CASE WHEN l_returnflag = 'N' THEN 'Cofunding' ELSE 'Platform' END,
           Food_spend_amount := CASE WHEN disc <> 0 THEN CAST(price * disc AS {AMOUNT}) END)) AS rpl_detail_list
  FROM lines
  GROUP BY o_orderkey, l_suppkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
),
booking_cm AS (
  SELECT concat(o_orderkey, '-', l_suppkey) AS order_no,
         {local_date('o_orderdate')} AS booking_date,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(sum(price * (1 - disc)) AS {AMOUNT}) END AS cm_amount,
         CAST(sum(price * CAST(0.7 AS DECIMAL(2,1))) AS {AMOUNT}) AS cost_of_revenue_amount,
         CAST(sum(price) AS {AMOUNT}) AS gtv_amount,
         CAST(sum(price * tax) AS {AMOUNT}) AS gross_take_preoffset_amount,
         CAST(sum(price * CAST(0.2 AS DECIMAL(2,1))) AS {AMOUNT}) AS merchant_commission_amount,
         CAST(sum(price * disc) AS {AMOUNT}) AS mfp_markdown_amount,
         CAST(sum(CASE WHEN l_linestatus = 'F' THEN price * disc ELSE 0 END) AS {AMOUNT}) AS net_rpl_amount,
         CAST(sum(price * (disc + tax)) AS {AMOUNT}) AS gross_rpl_amount,
         CAST(sum(price) AS {AMOUNT}) AS gmv_amount
  FROM lines
  WHERE o_orderstatus <> 'P'
  GROUP BY o_orderkey, l_suppkey, o_orderdate
),
promo_tx AS (
  SELECT concat(o_orderkey, '-', l_suppkey) AS order_no,
         {local_date('o_orderdate')} AS jakarta_booking_date,
         CAST(sum(price * disc) AS {AMOUNT}) AS item_promotion_burnt_amount,
         CAST(sum(CASE WHEN l_tax > 0.04 THEN price * tax ELSE 0 END) AS {AMOUNT}) AS campaign_discount_burnt_amount,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN price * disc ELSE 0 END) AS {AMOUNT}) AS voucher_burnt_amount,
         CAST(CAST(sum(price * disc) AS {AMOUNT})
              + CAST(sum(CASE WHEN l_tax > 0.04 THEN price * tax ELSE 0 END) AS {AMOUNT})
              + CAST(sum(CASE WHEN l_returnflag = 'R' THEN price * disc ELSE 0 END) AS {AMOUNT}) AS {AMOUNT})
           AS total_order_burnt_amount,
         o_custkey AS customer_id
  FROM lines
  WHERE l_discount >= 0.02
  GROUP BY o_orderkey, l_suppkey, o_orderdate, o_custkey, o_orderpriority
),
spine AS (
  SELECT jakarta_booking_created_date AS summary_data_date,
         restaurant_id AS Food_id,
         CAST(sum(CASE WHEN status_id = '3' THEN normalized_gmv_amount END) AS {AMOUNT}) AS completed_Food_gmv_amount,
         CAST(sum(CASE WHEN status_id = '3' THEN total_campaign_discount_cart_amount END) AS {AMOUNT}) AS completed_Food_mfp_markdown_amount,
         CAST(sum(CASE WHEN status_id = '3' THEN estimated_rpl_total_amount END) AS {AMOUNT}) AS completed_Food_mfp_sku_amount,
         CAST(sum(CASE WHEN status_id = '3' THEN voucher_discount_amount END) AS {AMOUNT}) AS completed_Food_mfp_voucher_amount,
         CAST(sum(CASE WHEN status_id = '3' THEN normalized_gmv_amount * CAST(0.200 AS DECIMAL(4,3)) END) AS {AMOUNT}) AS completed_merchant_commission_amount,
         CAST(sum(CASE WHEN status_id = '3' THEN rpl_voucher_amount END) AS {AMOUNT}) AS completed_Food_estimated_rpl_amount,
         CAST(sum(normalized_gmv_amount * CAST(0.010 AS DECIMAL(4,3))) AS {AMOUNT}) AS ads_booked_amount,
         CAST(sum(normalized_gmv_amount * CAST(0.008 AS DECIMAL(4,3))) AS {AMOUNT}) AS ads_realized_amount,
         CAST(sum(CASE WHEN status_id = '3' THEN normalized_gmv_amount * CAST(0.006 AS DECIMAL(4,3)) END) AS {AMOUNT}) AS ads_booked_paid_revenue_amount,
         CAST(sum(CASE WHEN status_id = '3' THEN normalized_gmv_amount * CAST(0.005 AS DECIMAL(4,3)) END) AS {AMOUNT}) AS ads_realized_paid_revenue_amount,
         CAST(sum(CASE WHEN status_id = '3' THEN 1 ELSE 0 END) AS BIGINT) AS completed_Food_order_number,
         CAST(count(*) AS BIGINT) AS all_Food_order_number
  FROM bookings
  GROUP BY 1, 2
),
ev AS (
  SELECT event_id, user_id, event_type, value,
         ts - INTERVAL 26 YEAR AS utc_ts,
         CAST(ts - INTERVAL 26 YEAR + INTERVAL 7 HOUR AS DATE) AS local_date,
         concat('uuid-', user_id) AS restaurant_uuid
  FROM events
),
ads AS (
  SELECT local_date AS jakarta_data_date,
         local_date + CAST(event_id % 40 - 10 AS INTEGER) AS jakarta_end_date,
         restaurant_uuid,
         CASE WHEN event_type IN ('purchase', 'click') THEN 'PAID' WHEN event_type = 'view' THEN 'FREE'
              WHEN event_type = 'signup' THEN 'Shadow' END AS member_type,
         CASE event_id % 7 WHEN 0 THEN 'Food Search Ads' WHEN 1 THEN 'Food Category Ads'
              WHEN 2 THEN 'Food CPC Fungible Ads' WHEN 3 THEN 'Food Top Banner' WHEN 4 THEN 'Partner Jempolan'
              WHEN 5 THEN 'Food Masthead' ELSE 'Food Brand Ads' END AS inventory_name,
         CASE event_id % 5 WHEN 0 THEN 'recommended_package' WHEN 1 THEN 'cms_upload'
              WHEN 2 THEN 'self_serve_wizard' WHEN 3 THEN 'organic' END AS sales_channel_name,
         CAST(value AS {GMV}) AS booked_revenue_amount,
         CAST(CAST(value AS {GMV}) * CAST(0.9 AS DECIMAL(2,1)) AS {AMOUNT}) AS billed_revenue_amount,
         CAST(CAST(value AS {GMV}) * 10 AS {GMV}) AS direct_gmv_amount,
         CAST(CAST(value AS {GMV}) * 4 AS {GMV}) AS indirect_gmv_amount,
         event_id % 1000 AS realized_impression_count,
         event_id % 50 AS realized_click_count,
         event_id % 3 AS direct_completed_order_count,
         event_id % 4 AS indirect_completed_order_count,
         user_id % 5 AS new_user_count,
         event_id % 6 AS existing_user_count,
         event_id % 2 AS dormant_user_count
  FROM ev
),
funnel AS (
  SELECT local_date AS summary_data_date, restaurant_uuid,
         event_id % 17 AS profile_visit_over_merchant_count,
         event_id % 5 AS add_to_cart_over_merchant_count
  FROM ev WHERE event_type IN ('view', 'click')
),
rating AS (
  SELECT utc_ts AS created_timestamp, restaurant_uuid,
         event_id % 9 + 1 AS rating_count,
         CAST(event_id % 5 + 1 AS DOUBLE) AS average_restaurant_rating,
         CAST(user_id % 5 + 1 AS DOUBLE) AS restaurant_rating
  FROM ev WHERE event_type = 'purchase'
),
impressions AS (
  SELECT local_date AS summary_data_date, restaurant_uuid,
         event_id % 11 AS Food_shuffle_impression_count,
         event_id % 13 AS Food_search_impression_count,
         event_id % 7 AS Food_suggestion_impression_count,
         event_id % 11 + event_id % 13 + event_id % 7 AS Food_total_impression_count
  FROM ev WHERE event_type IN ('view', 'error')
),
profile AS (
  SELECT s.s_suppkey AS restaurant_id,
         concat('uuid-', s.s_suppkey) AS restaurant_uuid,
         n.n_name AS service_area_name,
         concat('ENT-', s.s_suppkey % 50) AS sf_entity_id,
         s.s_suppkey % 10 AS brand_id,
         concat('Brand ', s.s_suppkey % 10) AS brand_name,
         s.s_name AS restaurant_name,
         CASE s.s_suppkey % 4 WHEN 0 THEN 'Indonesian' WHEN 1 THEN 'Chinese' WHEN 2 THEN 'Japanese'
              ELSE 'Western' END AS primary_cuisine_name,
         concat('Parent ', s.s_suppkey % 20) AS sf_parent_entity_name,
         CASE WHEN n.n_regionkey = 1 THEN 'ENTERPRISE' ELSE 'SME' END AS classification_type_name,
         r.r_name AS general_group_name,
         s.s_suppkey AS merchant_platform_outlet_id,
         CAST(s.s_nationkey * 10 + s.s_suppkey % 3 AS BIGINT) AS location_s2id_14
  FROM supplier s
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
universe AS (
  SELECT s_suppkey AS Food_id, concat('SC-', s_nationkey) AS sales_code,
         concat('Sales team ', s_nationkey % 5) AS sales_name
  FROM supplier WHERE s_acctbal >= 0
),
geo AS (
  SELECT CAST(n.n_nationkey * 10 + c.cell AS BIGINT) AS location_s2id_14,
         concat(n.n_name, '-D', c.cell) AS subdistrict_name,
         concat(n.n_name, '-R', c.cell % 2) AS regency_name,
         r.r_name AS sales_region_name
  FROM nation n
  JOIN (SELECT unnest([0, 1, 2]) AS cell) c ON TRUE
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
versions AS (
  SELECT o_orderkey, o_custkey, o_orderdate,
         o_orderdate + INTERVAL 18 HOUR AS effective_timestamp,
         lead(o_orderdate + INTERVAL 18 HOUR) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
           AS expired_timestamp
  FROM orders
),
dim_outlet AS (
  SELECT concat('SO-', o_custkey) AS sf_outlet_id, o_custkey AS outlet_id,
         concat('ENT-', o_orderkey % 50) AS sf_account_id,
         effective_timestamp, expired_timestamp,
         CASE o_orderkey % 7 WHEN 0 THEN TRUE WHEN 1 THEN NULL ELSE FALSE END AS deleted_flag,
         CASE o_orderkey % 11 WHEN 0 THEN TRUE WHEN 1 THEN NULL ELSE FALSE END AS duplicate_flag
  FROM versions
),
dim_account AS (
  SELECT concat('PO-', o_orderkey) AS sf_account_id, concat('SO-', o_custkey) AS sf_outlet_id,
         concat('Outlet ', o_custkey) AS sf_account_name, concat('ENT-', o_orderkey % 50) AS parent_id,
         CAST(NULL AS VARCHAR) AS parent_entity_detail_name,
         CASE WHEN o_orderkey % 5 = 0 THEN 'Product Outlet Mart' ELSE 'Product Outlet Food' END AS record_type_name_detail,
         'FOOD' AS service_product_list_name,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE concat('BG-', o_custkey % 30) END AS billing_group_entity_id,
         effective_timestamp, expired_timestamp,
         CASE o_orderkey % 7 WHEN 3 THEN TRUE WHEN 4 THEN NULL ELSE FALSE END AS deleted_flag
  FROM versions
  UNION ALL
  SELECT concat('BG-', o_custkey), NULL, concat('Billing group ', o_custkey), NULL,
         concat('BG parent ', o_orderkey), 'Billing Group', 'FOOD', NULL,
         effective_timestamp, expired_timestamp,
         CASE o_orderkey % 7 WHEN 5 THEN TRUE WHEN 6 THEN NULL ELSE FALSE END
  FROM versions
  UNION ALL
  SELECT concat('ENT-', o_custkey), NULL, concat('Entity ', o_custkey, ' rev ', o_orderkey), NULL,
         NULL, 'Entity', 'GO-FOOD', NULL,
         effective_timestamp, expired_timestamp,
         CASE o_orderkey % 7 WHEN 5 THEN TRUE WHEN 6 THEN NULL ELSE FALSE END
  FROM versions
),
fx AS ({fx})"""


def window_dates(run_date: dt.date) -> tuple[str, str, str, str]:
    """(start, end, utc_lo, utc_hi) literals for the month-to-date window."""
    end = run_date - dt.timedelta(days=1)
    start = end.replace(day=1)
    lo = dt.datetime.combine(start, dt.time(0)) - dt.timedelta(hours=7)
    hi = dt.datetime.combine(end + dt.timedelta(days=1), dt.time(0)) - dt.timedelta(hours=7)
    return (start.isoformat(), end.isoformat(),
            lo.strftime("%Y-%m-%d %H:%M:%S"), hi.strftime("%Y-%m-%d %H:%M:%S"))
