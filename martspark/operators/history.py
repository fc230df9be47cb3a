"""Type-2 history: as-of filters and the outlet bridge.

A history row is valid on local date ``d`` when its effective date is on or
before ``d`` and it is open (NULL expiry) or expires after ``d``. These are
plain filters: they run inside the scan stage, no shuffle.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martspark.functions import constants as K
from martspark.functions.calendar import DEFAULT_TZ, MonthWindow, ntz_literal, utc_bounds
from martspark.plans.joins import lookup_side
from martspark.sources.layout import EXPIRED_MONTH, open_partitions


def valid_on(as_of: dt.date, tz: str = DEFAULT_TZ,
             eff: str = "effective_timestamp", exp: str = "expired_timestamp") -> Column:
    """C15 (repaired): NULL expiry means open; dates compared in ``tz``.

    Both comparisons are against the instant of the next local midnight, so
    they reach the scan: effective before it, expired not before it.
    """
    _, midnight = utc_bounds(MonthWindow(as_of, as_of), tz)
    until = ntz_literal(midnight)
    return (F.col(eff) < until) & (F.col(exp).isNull() | (F.col(exp) >= until))


def valid_rows(history: DataFrame, as_of: dt.date, tz: str = DEFAULT_TZ) -> Column:
    """C15 on a table; of one stored by expiry month, months closed before the date are not read."""
    if EXPIRED_MONTH not in history.columns:
        return valid_on(as_of, tz)
    _, midnight = utc_bounds(MonthWindow(as_of, as_of), tz)
    return valid_on(as_of, tz) & open_partitions(midnight)


def not_deleted_strict(col: str = "deleted_flag") -> Column:
    """``NOT deleted_flag`` (a NULL flag drops the row)."""
    return ~F.col(col)


def not_flagged(col: str) -> Column:
    """C17: ``IFNULL(flag, FALSE) IS FALSE`` (a NULL flag keeps the row)."""
    return F.coalesce(F.col(col), F.lit(False)) == F.lit(False)


def outlets_as_of(dim_outlet: DataFrame, as_of: dt.date, tz: str = DEFAULT_TZ) -> DataFrame:
    """The ``outlet`` relation: valid, not deleted, not duplicate outlets."""
    return (dim_outlet
            .where(valid_rows(dim_outlet, as_of, tz) & not_deleted_strict() & not_flagged("duplicate_flag"))
            .select("sf_outlet_id", "outlet_id", F.col("sf_account_id").alias("entity_id"))
            .distinct())


@dataclass(frozen=True)
class BridgeRules:
    """Filters of the three account roles; defaults are the repaired rules.

    ``entity_type`` is compared after UPPER(); the literal reference text
    compares with "Entity", which never matches (pass that to reproduce).
    """

    product_outlet_pattern: str = K.PRODUCT_OUTLET_PATTERN
    billing_group_type: str = K.BILLING_GROUP_TYPE
    billing_group_product: str = K.BILLING_GROUP_PRODUCT
    entity_type: str = K.ENTITY_TYPE
    entity_product: str = K.ENTITY_PRODUCT


def product_outlets_as_of(dim_account: DataFrame, as_of: dt.date, rules: BridgeRules,
                          tz: str = DEFAULT_TZ) -> DataFrame:
    return (dim_account
            .where(F.lower(F.col("record_type_name_detail")).like(rules.product_outlet_pattern)
                   & valid_rows(dim_account, as_of, tz) & not_flagged("deleted_flag")
                   & F.col("billing_group_entity_id").isNotNull())
            .select("sf_outlet_id", "record_type_name_detail", "parent_id", "billing_group_entity_id")
            .distinct())


def billing_groups_as_of(dim_account: DataFrame, as_of: dt.date, rules: BridgeRules,
                         tz: str = DEFAULT_TZ) -> DataFrame:
    """Billing-group accounts as of the date."""
    return (dim_account
            .where((F.upper(F.col("record_type_name_detail")) == rules.billing_group_type)
                   & (F.col("service_product_list_name") == rules.billing_group_product)
                   & valid_rows(dim_account, as_of, tz) & not_flagged("deleted_flag"))
            .select("sf_account_id", "parent_entity_detail_name"))


def entities_as_of(dim_account: DataFrame, as_of: dt.date, rules: BridgeRules,
                   tz: str = DEFAULT_TZ) -> DataFrame:
    return (dim_account
            .where((F.upper(F.col("record_type_name_detail")) == rules.entity_type)
                   & (F.col("service_product_list_name") == rules.entity_product)
                   & valid_rows(dim_account, as_of, tz) & not_flagged("deleted_flag"))
            .select("sf_account_id", F.col("sf_account_name").alias("parent_entity_detail_name")))


def outlet_roles(dim_outlet: DataFrame, dim_account: DataFrame, as_of: dt.date,
                 rules: BridgeRules = BridgeRules(), tz: str = DEFAULT_TZ) -> DataFrame:
    """D11 with all three roles: outlet -> product outlet -> billing group and entity.

    Each outlet's rows carry the parent of its billing group (C8) and its
    entity's name; several versions of a group fan out and DISTINCT folds
    equal rows. Without the billing group this is :func:`outlet_bridge`.
    """
    outlet = outlets_as_of(dim_outlet, as_of, tz)
    po = product_outlets_as_of(dim_account, as_of, rules, tz)
    groups = billing_groups_as_of(dim_account, as_of, rules, tz).select(
        F.col("sf_account_id").alias("_bg"), F.col("parent_entity_detail_name").alias("billing_group_parent")).distinct()
    ent = entities_as_of(dim_account, as_of, rules, tz)
    return (outlet.join(po, "sf_outlet_id", "inner")
                  .join(lookup_side(groups), F.col("billing_group_entity_id") == F.col("_bg"), "left")
                  .join(lookup_side(ent), po.parent_id == ent.sf_account_id, "left")
                  .select("outlet_id", F.col("entity_id").alias("sf_entity_id"), "billing_group_parent",
                          "parent_entity_detail_name")
                  .distinct())


def outlet_bridge(dim_outlet: DataFrame, dim_account: DataFrame, as_of: dt.date,
                  rules: BridgeRules = BridgeRules(), tz: str = DEFAULT_TZ, count_lookups: bool = True) -> DataFrame:
    """Outlet -> product outlet -> entity, as of ``as_of``.

    The LEFT JOIN to product outlets is inner because of the WHERE on its
    record type (D9). The billing-group join of the reference reads no
    column and only fans out under DISTINCT, so it is left out (repair 10).
    All three inputs are one scan of ``dim_account`` in three filters (D12).
    """
    outlet = outlets_as_of(dim_outlet, as_of, tz)
    po = product_outlets_as_of(dim_account, as_of, rules, tz)
    # Entities are few and many outlets share one parent: broadcast them
    # (after a bounded count) so a popular parent is not a skewed join key.
    ent = entities_as_of(dim_account, as_of, rules, tz)
    if count_lookups:
        ent = lookup_side(ent)
    return (outlet.join(po, "sf_outlet_id", "inner")
                  .join(ent, po.parent_id == ent.sf_account_id, "left")
                  .select("outlet_id", F.col("entity_id").alias("sf_entity_id"),
                          "parent_entity_detail_name")
                  .distinct())
