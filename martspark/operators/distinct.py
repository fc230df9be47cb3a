"""Several COUNT(DISTINCT ...) in one group without ``Expand``.

Spark plans k distinct aggregates in one ``agg`` by replicating every
input row k+1 times (``Expand``) before shuffling. Instead each counted
value has its own two-level aggregate: first by (keys, value), combined
before the shuffle, then by the keys. Counts of the same unit (an order)
under different conditions share one: grouped by (keys, unit) they are plain
counts of per-unit flags, "some row of this unit meets the condition", and
sums are sums of per-unit sums. The results, one row per group, are joined on
the keys.

Exact for any input, duplicates included; every shuffle but the last is
keyed by (keys, counted value), so a hot group spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martspark.plans.joins import null_safe_join


def per_value(rows: DataFrame, keys: Sequence[str], value: Column, agg: Column) -> DataFrame:
    """``agg`` over the distinct values (column ``_value``) of each group.

    No row is filtered: a filter would sink below the rows' own aggregates
    and keep Spark from reusing their shuffle for the other aggregates.
    """
    return rows.select(*keys, value.alias("_value")).distinct().groupBy(*keys).agg(agg)


def distinct_rollup(rows: DataFrame, keys: Sequence[str], unit: str,
                    unit_counts: Mapping[str, Column | None],
                    sums: Mapping[str, Column],
                    other_distinct: Mapping[str, Column] | None = None) -> DataFrame:
    """Group ``rows`` by ``keys`` with

    * ``unit_counts[name] = cond``: ``COUNT(DISTINCT CASE WHEN cond THEN unit END)``
      (``None`` means ``COUNT(DISTINCT unit)``),
    * ``sums[name] = expr``: ``SUM(expr)``,
    * ``other_distinct[name] = expr``: ``COUNT(DISTINCT expr)``.

    Output columns: keys, then the names in the order given above.
    """
    flags = {n: (F.lit(True) if c is None else c) for n, c in unit_counts.items()}
    per_unit = rows.groupBy(*keys, unit).agg(
        *[F.max(c).alias(f"_f_{n}") for n, c in flags.items()],
        *[F.sum(e).alias(f"_s_{n}") for n, e in sums.items()],
    )
    has_unit = F.col(unit).isNotNull()
    out = per_unit.groupBy(*keys).agg(
        *[F.count_if(F.col(f"_f_{n}") & has_unit).alias(n) for n in flags],
        *[F.sum(f"_s_{n}").alias(n) for n in sums],
    )
    for n, e in (other_distinct or {}).items():
        out = null_safe_join(out, per_value(rows, keys, e, F.count("_value").alias(n)), keys)
    return out
