"""Spine joins of daily branches.

Every branch enters keyed by ``(_d, _id)`` (day, restaurant) with at most
one row per key. Branches whose own grain is finer (uuid in the key, or
a distinct projection) are re-aggregated first (repair 17), so no join
can multiply a measure.

All joins use the same two keys, so after the first exchange the spine
side stays hash-partitioned on ``(_d, _id)`` and the chain of left joins
does not re-shuffle it; each branch is shuffled once (its aggregate's
exchange is reused when partitioning matches).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martspark.functions import constants as K
from martspark.functions.calendar import MonthWindow

DAY, RID = "_d", "_id"


@dataclass
class Branch:
    """A daily branch keyed by ``(_d, _id)``; ``measures`` are its other columns."""

    name: str
    df: DataFrame

    @property
    def measures(self) -> list[str]:
        return [c for c in self.df.columns if c not in (DAY, RID)]


def keyed(name: str, df: DataFrame, date_col: str, id_col: str,
          rename: dict[str, str] | None = None,
          resum: Sequence[str] | None = None) -> Branch:
    """Key a branch by (day, restaurant).

    ``rename`` maps measure names (to avoid clashes between branches);
    ``resum`` re-aggregates the listed measures with SUM to one row per key.
    """
    rename = rename or {}
    keep = [c for c in df.columns if c not in (date_col, id_col)]
    if resum is not None:
        keep = list(resum)
    out = df.select(F.col(date_col).alias(DAY), F.col(id_col).alias(RID),
                    *[F.col(c).alias(rename.get(c, c)) for c in keep])
    if resum is not None:
        names = [rename.get(c, c) for c in resum]
        out = out.groupBy(DAY, RID).agg(*[F.sum(c).alias(c) for c in names])
    return Branch(name, out)


def spine_left_join(spine: Branch, dim: DataFrame, branches: Sequence[Branch],
                    window: MonthWindow, classification: str = K.ENTERPRISE) -> DataFrame:
    """Spine in window, INNER the classified dimension, LEFT each branch.

    This is what the reference's FULL JOIN chain computes once its WHERE
    clause is applied (the dimension joins only on the spine id, and the
    WHERE needs the dimension), written directly.
    """
    s = spine.df.where(window.contains(F.col(DAY)))
    d = dim.where(F.col("classification_type_name") == classification)
    d = d.select(*[F.col(c).alias(f"dim__{c}") for c in d.columns])
    # Branch joins first, all on (day, restaurant), so the spine keeps one
    # partitioning through the chain; the wide dimension comes last (a
    # broadcast when small, else one shuffle on the restaurant id).
    j = s
    for b in branches:
        j = j.join(b.df, [DAY, RID], "left")
    return j.join(d, F.col(RID) == F.col("dim__restaurant_id"), "inner")


def spine_full_join_literal(spine: Branch, dim: DataFrame, branches: Sequence[Branch],
                            window: MonthWindow, classification: str = K.ENTERPRISE) -> DataFrame:
    """D5 + D6 as written: FULL JOIN every branch on the *spine's* keys, FULL
    JOIN the dimension on the spine id, then filter on the coalesced date and
    the class. Catalyst turns the chain into inner/left joins (the result
    equals :func:`spine_left_join`); kept to show and test that equivalence.

    The coalesced date keeps the window from the spine's scan, so the spine is
    windowed first: a joined row's first date is the spine's own, and rows
    without a spine row have no dimension and fail the class filter.
    """
    a = spine.df.where(window.contains(F.col(DAY))).select(*[F.col(c).alias(f"a__{c}") for c in spine.df.columns])
    j = a
    dates: list[Column] = [F.col(f"a__{DAY}")]
    for b in branches:
        p = b.name
        bd = b.df.select(*[F.col(c).alias(f"{p}__{c}") for c in b.df.columns])
        j = j.join(bd, (F.col(f"a__{RID}") == F.col(f"{p}__{RID}"))
                   & (F.col(f"a__{DAY}") == F.col(f"{p}__{DAY}")), "full")
        dates.append(F.col(f"{p}__{DAY}"))
    d = dim.select(*[F.col(c).alias(f"dim__{c}") for c in dim.columns])
    j = j.join(d, F.col(f"a__{RID}") == F.col("dim__restaurant_id"), "full")
    j = j.where(window.contains(F.coalesce(*dates))
                & (F.col("dim__classification_type_name") == classification))
    # back to the common naming: keys from the spine, measures unprefixed
    cols = [F.col(f"a__{DAY}").alias(DAY), F.col(f"a__{RID}").alias(RID)]
    cols += [F.col(f"a__{c}").alias(c) for c in spine.measures]
    cols += [F.col(c) for c in j.columns if c.startswith("dim__")]
    for b in branches:
        cols += [F.col(f"{b.name}__{c}").alias(c) for c in b.measures]
    return j.select(*cols)


def spine_full_join_coalesced(spine: Branch, dim: DataFrame, branches: Sequence[Branch],
                              window: MonthWindow, classification: str = K.ENTERPRISE) -> DataFrame:
    """D5 repaired ``full`` mode: the rows of FULL JOIN USING (day,
    restaurant) over all branches, so a day that has ads or ratings but no
    spine row is kept; then the classified dimension (inner) and the window
    on the merged day.

    Every input has at most one row per key (branches by construction, the
    spine summed per key here), so the FULL JOIN chain equals a union of
    the branches followed by one GROUP BY on the key: one shuffle with
    map-side combine, where nine chained full joins would re-shuffle the
    growing left side each time (a full join's merged key has no known
    partitioning). A row of the union carries its branch's measures as one
    struct and NULL for every other branch, not some 70 padded columns, and the
    group picks one struct a branch.
    """
    # Branches are already windowed; a spine row outside the window could
    # only merge with branch rows outside it, so windowing it first is exact.
    s = spine.df.where(window.contains(F.col(DAY)))
    s = s.groupBy(DAY, RID).agg(*[F.sum(c).alias(c) for c in spine.measures])
    parts = {"_spine": (s, spine.measures), **{f"_b_{b.name}": (b.df, b.measures) for b in branches}}
    frames = [df.select(DAY, RID, F.struct(*cols).alias(name)) for name, (df, cols) in parts.items()]
    u = reduce(lambda l, r: l.unionByName(r, allowMissingColumns=True), frames)
    j = u.groupBy(DAY, RID).agg(*[F.any_value(name, ignoreNulls=F.lit(True)).alias(name) for name in parts])
    j = j.select(DAY, RID, *[F.col(name)[c].alias(c) for name, (_, cols) in parts.items() for c in cols])
    d = dim.where(F.col("classification_type_name") == classification)
    d = d.select(*[F.col(c).alias(f"dim__{c}") for c in d.columns])
    j = j.where(window.contains(F.col(DAY)))
    return j.join(d, F.col(RID) == F.col("dim__restaurant_id"), "inner")


def spine_full_join_chain(spine: Branch, dim: DataFrame, branches: Sequence[Branch],
                          window: MonthWindow, classification: str = K.ENTERPRISE) -> DataFrame:
    """The same ``full`` mode as a chain of FULL JOIN USING (kept for the
    equivalence test)."""
    s = spine.df.where(window.contains(F.col(DAY)))
    s = s.groupBy(DAY, RID).agg(*[F.sum(c).alias(c) for c in spine.measures])
    j = reduce(lambda l, r: l.join(r, [DAY, RID], "full"), [b.df for b in branches], s)
    d = dim.where(F.col("classification_type_name") == classification)
    d = d.select(*[F.col(c).alias(f"dim__{c}") for c in d.columns])
    j = j.where(window.contains(F.col(DAY)))
    return j.join(d, F.col(RID) == F.col("dim__restaurant_id"), "inner")


SPINE_MODES = {
    "left": spine_left_join,
    "literal": spine_full_join_literal,
    "full": spine_full_join_coalesced,
}
