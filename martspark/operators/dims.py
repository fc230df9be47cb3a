"""Restaurant dimensions (J2, J4) and the enterprise lookup used by branches."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martspark.functions import constants as K
from martspark.functions.calendar import DEFAULT_TZ
from martspark.operators.history import BridgeRules, outlet_bridge
from martspark.operators.quality import assert_unique
from martspark.plans.joins import DEFAULT_BROADCAST_ROWS, WIDE_BROADCAST_ROWS, lookup_side

DIM_COLUMNS = [
    "sales_code", "sales_name", "saudagar_id", "restaurant_id", "restaurant_uuid",
    "service_area_name", "sf_entity_id", "brand_id", "brand_name", "restaurant_name",
    "primary_cuisine_name", "sf_parent_entity_name", "classification_type_name",
    "general_group_name",
]

ENRICHED_COLUMNS = [
    "saudagar_id", "restaurant_id", "restaurant_uuid", "service_area_name", "sf_entity_id",
    "brand_id", "brand_name", "restaurant_name", "primary_cuisine_name",
    "sf_parent_entity_name", "classification_type_name", "general_group_name",
    "subdistrict_name", "regency_name", "sales_region_name",
]


def restaurant_dim(profile: DataFrame, universe: DataFrame) -> DataFrame:
    """Profile LEFT JOIN outlet universe, DISTINCT 14 columns."""
    u = universe.select(F.col("Food_id").alias("_u_id"), "sales_code", "sales_name")
    return (profile.join(u, F.col("_u_id") == profile.restaurant_id, "left")
                   .select(F.col("sales_code"), F.col("sales_name"),
                           F.col("merchant_platform_outlet_id").alias("saudagar_id"),
                           *DIM_COLUMNS[3:])
                   .distinct())


def restaurant_dim_enriched(profile: DataFrame, universe: DataFrame, bridge: DataFrame,
                            geo: DataFrame, count_lookups: bool = True) -> DataFrame:
    """Profile + universe + outlet bridge + geo cells.

    The bridge overrides the entity id and parent name when present
    (``COALESCE(bridge, profile)``). Universe and geo are lookups joined on
    their unique keys.
    """
    u = universe.select(F.col("Food_id").alias("_u_id"))
    b = bridge.select(F.col("outlet_id").alias("_b_outlet"),
                      F.col("sf_entity_id").alias("_b_entity"),
                      F.col("parent_entity_detail_name").alias("_b_parent"))
    g = geo.select(F.col("location_s2id_14").alias("_g_cell"),
                   "subdistrict_name", "regency_name", "sales_region_name")
    joined = (profile.join(u, F.col("_u_id") == profile.restaurant_id, "left")
                     .join(b, F.col("_b_outlet") == profile.merchant_platform_outlet_id, "left")
                     .join(lookup_side(g) if count_lookups else g, F.col("_g_cell") == profile.location_s2id_14, "left"))
    return joined.select(
        F.col("merchant_platform_outlet_id").alias("saudagar_id"),
        "restaurant_id", "restaurant_uuid", "service_area_name",
        F.coalesce(F.col("_b_entity"), F.col("sf_entity_id")).alias("sf_entity_id"),
        "brand_id", "brand_name", "restaurant_name", "primary_cuisine_name",
        F.coalesce(F.col("_b_parent"), F.col("sf_parent_entity_name")).alias("sf_parent_entity_name"),
        "classification_type_name", "general_group_name",
        "subdistrict_name", "regency_name", "sales_region_name",
    ).distinct()


def enterprise_slice(dim: DataFrame, classification: str = K.ENTERPRISE) -> DataFrame:
    return dim.where(F.col("classification_type_name") == classification)


@dataclass
class Enterprise:
    """The enterprise slice of a restaurant dimension, prepared once.

    ``dim``   full rows (unique on ``restaurant_id``, checked when asked),
    ``ids``   ``restaurant_id`` only, for inner restrictions of id-keyed facts,
    ``uuids`` ``restaurant_uuid -> restaurant_id``, for uuid-keyed facts.
    The two key tables are broadcast only after a row count; every branch
    then reuses the one broadcast.
    """

    dim: DataFrame
    ids: DataFrame
    uuids: DataFrame

    @classmethod
    def of(cls, dim: DataFrame, classification: str = K.ENTERPRISE,
           check_unique: bool = True, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> "Enterprise":
        ent = enterprise_slice(dim, classification)
        # One job answers all three questions: row count (broadcast bound),
        # distinct ids and distinct uuids (fan-out guards).
        stats = ent.agg(F.count(F.lit(1)).alias("n"),
                        F.count_distinct("restaurant_id").alias("n_id"),
                        F.count_distinct("restaurant_uuid", "restaurant_id").alias("n_pair"),
                        F.count_distinct("restaurant_uuid").alias("n_uuid")).first()
        unique_ids = stats["n_id"] == stats["n"]
        if check_unique:
            if not unique_ids:
                assert_unique(ent, ["restaurant_id"], "enterprise restaurant dimension")
            if stats["n_uuid"] != stats["n_pair"]:
                assert_unique(ent.select("restaurant_uuid", "restaurant_id").distinct(),
                              ["restaurant_uuid"], "enterprise restaurant uuid map")
        small = stats["n"] <= max_broadcast_rows
        ids = ent.select("restaurant_id")
        uuids = ent.select("restaurant_uuid", "restaurant_id")
        if not unique_ids:
            ids, uuids = ids.distinct(), uuids.distinct()
        if small:
            ids, uuids = F.broadcast(ids), F.broadcast(uuids)
        # full rows are ~10x wider than the key tables: a tighter bound
        wide_small = stats["n"] <= max_broadcast_rows * WIDE_BROADCAST_ROWS // DEFAULT_BROADCAST_ROWS
        return cls(dim=F.broadcast(ent) if wide_small else ent, ids=ids, uuids=uuids)

    def restrict(self, df: DataFrame, id_col: str = "restaurant_id") -> DataFrame:
        """Keep rows of enterprise restaurants (the D9 inner join)."""
        return df.join(self.ids.withColumnRenamed("restaurant_id", "_ent_id"),
                       F.col(id_col) == F.col("_ent_id"), "left_semi")

    def by_uuid(self, df: DataFrame, uuid_col: str = "restaurant_uuid") -> DataFrame:
        """Inner join on the uuid, adding ``restaurant_id``."""
        u = self.uuids.withColumnRenamed("restaurant_uuid", "_ent_uuid")
        return df.join(u, F.col(uuid_col) == F.col("_ent_uuid"), "inner").drop("_ent_uuid")


def enriched_dim_as_of(profile: DataFrame, universe: DataFrame, geo: DataFrame,
                       dim_outlet: DataFrame, dim_account: DataFrame, as_of: dt.date,
                       rules: BridgeRules = BridgeRules(), tz: str = DEFAULT_TZ,
                       count_lookups: bool = True) -> DataFrame:
    """J4 as of a date. ``count_lookups`` counts the lookups to broadcast small ones; without it no job
    is started and adaptive execution decides from measured sizes."""
    bridge = outlet_bridge(dim_outlet, dim_account, as_of, rules, tz, count_lookups)
    return restaurant_dim_enriched(profile, universe, bridge, geo, count_lookups)
