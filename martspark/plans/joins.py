"""Join helpers: size-checked broadcast and null-safe multi-key joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Row bound under which a lookup side is broadcast (counted
# first): the narrow restaurant key tables are a few tens of bytes per
# row, so this keeps a broadcast under ~100 MB per executor.
DEFAULT_BROADCAST_ROWS = 2_000_000
# Rows of a wide dimension (a dozen string attributes) are ~10x larger.
WIDE_BROADCAST_ROWS = DEFAULT_BROADCAST_ROWS // 10


def lookup_side(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when its row count is proven within the bound.

    The count is a plain distributed one (partial counts per partition).
    Beyond the bound the plain DataFrame is returned and Spark uses a
    shuffle join (AQE may still switch to broadcast from measured sizes,
    and splits skewed partitions of the large side).
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Join on ``keys`` treating NULL = NULL (for group keys with NULL names)."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = term if cond is None else cond & term
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])
