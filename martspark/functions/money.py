"""FX conversion by year.

Rates are a relation with one row per year. ``FxRates`` is that relation after
its check: a second row for a year would multiply every converted sum of
that year (the reference carries two 2024 rows). Every operator that converts
takes ``FxRates``, or a plain relation, which is checked on the spot. Its size is
bounded by the number of years, so broadcasting it is safe.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.operators.quality import assert_unique

RATE_TYPE = "decimal(18,4)"


@dataclass(frozen=True)
class FxRates:
    """``(year int, rate decimal(18,4))`` with one row per year; made by :func:`fx_table` or :meth:`of`."""

    frame: DataFrame

    @classmethod
    def of(cls, fx: "FxRates | DataFrame") -> "FxRates":
        """Checked rates; :class:`FanOutError` if a year of a plain relation has two."""
        return fx if isinstance(fx, cls) else cls(assert_unique(fx, ["year"], "FX relation"))


def fx_table(spark: SparkSession, rates: Mapping[int, float] | list[tuple[int, float]]) -> FxRates:
    """Rates given as literals; a year given twice is refused."""
    rows = list(rates.items()) if isinstance(rates, Mapping) else list(rates)
    years = [y for y, _ in rows]
    if len(years) != len(set(years)):
        dup = sorted({y for y in years if years.count(y) > 1})
        raise ValueError(f"FX table has more than one rate for year(s) {dup}")
    return FxRates(spark.createDataFrame(
        [(int(y), str(r)) for y, r in rows], "year int, rate string"
    ).select("year", F.col("rate").cast(RATE_TYPE).alias("rate")))


def with_rate(df: DataFrame, date_col: str, fx: FxRates | DataFrame, rate_col: str = "rate") -> DataFrame:
    """``LEFT JOIN fx ON EXTRACT(year FROM date) = fx.year``; the join cannot fan out."""
    rates = FxRates.of(fx).frame
    fx_b = F.broadcast(rates.select(F.col("year").alias("_fx_year"), F.col("rate").alias(rate_col)))
    return (df.join(fx_b, F.year(F.col(date_col)) == F.col("_fx_year"), "left")
              .drop("_fx_year"))
