"""Fan-out guards (D14, survey repairs 2, 16, 17).

A lookup joined on a non-unique key multiplies every measure of the
matching rows. ``duplicate_keys`` returns the offending keys as a
DataFrame (a grouped count: partial aggregation per partition, then one
shuffle of at most one row per key per partition); ``assert_unique``
fails with a bounded sample of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class FanOutError(ValueError):
    pass


#: Starts the message of a guard that fails while a plan runs.
GUARD = "FanOutError: "


def guarded(df: DataFrame, keys: Sequence[str], name: str = "lookup") -> DataFrame:
    """``df`` with one row for each of ``keys``; running it fails where a key has more.

    The check is part of the plan (the rows of a key meet in one small group),
    so building a query starts no job. :func:`raising_fan_out` gives the error its type.
    """
    others = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*others)).alias("_row"))
    shown = F.concat(F.lit(f"{GUARD}{name}: key {list(keys)} is not unique: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]),
                     F.lit(" x"), F.col("_n").cast("string"))
    row = F.when(F.col("_n") > 1, F.raise_error(shown)).otherwise(F.col("_row"))
    return one.select(*keys, row.alias("_row")).select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


@contextmanager
def raising_fan_out():
    """Raise a failed guard of a running plan as :class:`FanOutError`."""
    try:
        yield
    except PySparkException as failed:
        text = str(failed)
        if GUARD in text:
            raise FanOutError(text[text.index(GUARD) + len(GUARD):].splitlines()[0]) from failed
        raise


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, with their multiplicity ``n_rows``."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1))


def assert_unique(df: DataFrame, keys: Sequence[str], name: str = "lookup",
                  sample: int = 20) -> DataFrame:
    """Return ``df`` unchanged when ``keys`` are unique; raise otherwise.

    Only ``sample`` offending keys travel to the driver for the message.
    """
    bad = duplicate_keys(df, keys).limit(sample).collect()
    if bad:
        shown = ", ".join(str(tuple(r[k] for k in keys)) + f" x{r['n_rows']}" for r in bad)
        raise FanOutError(f"{name}: key {list(keys)} is not unique: {shown}")
    return df
