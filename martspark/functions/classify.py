"""CASE-built classes as Column expressions.

All of these compile to ``CaseWhen`` inside whole-stage codegen; no UDF.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from martspark.functions import constants as K


def bucketize(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Half-open bands ``[e_i, e_{i+1})``; NULL counts as 0.

    ``labels`` has ``len(edges) + 1`` entries (below the first edge .. at or
    above the last one).
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    v = F.coalesce(value, F.lit(0))
    expr = F.when(v < edges[0], labels[0])
    for lo, hi, label in zip(edges[:-1], edges[1:], labels[1:-1]):
        expr = expr.when((v >= lo) & (v < hi), label)
    return expr.when(v >= edges[-1], labels[-1])


def aov_band(value: Column) -> Column:
    return bucketize(value, K.AOV_EDGES, K.AOV_LONG_LABELS)


def relabel(col: Column, mapping: dict[str, str]) -> Column:
    """Simple CASE; unmapped values give NULL."""
    expr = None
    for src, dst in mapping.items():
        expr = F.when(col == src, dst) if expr is None else expr.when(col == src, dst)
    return expr


def flags_to_class(sku: Column, cart: Column, voucher: Column) -> Column:
    """Truth table of three amounts (> 0 vs = 0, NULL as 0).

    A negative amount matches no arm and gives NULL, like the reference.
    """
    parts = [F.coalesce(c, F.lit(0)) for c in (sku, cart, voucher)]
    expr = None
    for flags, label in K.PROMO_CLASS_BY_FLAGS.items():
        cond = None
        for part, flag in zip(parts, flags):
            term = part > 0 if flag else part == 0
            cond = term if cond is None else cond & term
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def channel_class(channel: Column) -> Column:
    """LIKE arms with ELSE; a NULL channel lands in the default."""
    expr = None
    for pattern, label in K.CHANNEL_PATTERNS:
        cond = channel.like(pattern)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(K.CHANNEL_DEFAULT)


@dataclass(frozen=True)
class CityTiers:
    """I16: three nested city lists with (inside, outside) labels."""

    tier3: tuple[str, ...] = tuple(K.T3_CITIES)
    focus: tuple[str, ...] = tuple(K.FOCUS_22_CITIES)
    top5: tuple[str, ...] = tuple(K.TOP_5_CITIES)

    def columns(self, area: Column) -> list[Column]:
        out = []
        for name, cities in (("city_category", self.tier3),
                             ("T3_categories", self.focus),
                             ("top_5_category", self.top5)):
            inside, outside = K.TIER_LABELS[name]
            out.append(F.when(area.isin(list(cities)), inside).otherwise(outside).alias(name))
        return out
