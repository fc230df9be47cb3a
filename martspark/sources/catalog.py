"""The set of mart inputs, as lazy DataFrames.

Any adapter (the driver-table mapping in :mod:`martspark.sources.tpch`, or
reads of the real warehouse tables) fills one of these; the marts only see
this object.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame


@dataclass
class Sources:
    bookings: DataFrame      # A3/A5 order bookings (one row per booking)
    booking_cm: DataFrame    # A4 booking economics
    promo_tx: DataFrame      # A14 promo transactions
    spine: DataFrame         # A7 daily merchant summary
    ads: DataFrame           # A6 ads campaign daily
    funnel: DataFrame        # A8 app funnel daily
    rating: DataFrame        # A9 rating rows
    impressions: DataFrame   # A10 impressions daily
    profile: DataFrame       # A1 restaurant profile
    universe: DataFrame      # A2 outlet universe
    geo: DataFrame           # A13 geo cells
    dim_outlet: DataFrame    # A11 outlet history
    dim_account: DataFrame   # A12 account history
    fx: DataFrame            # A15 FX by year
    econ_bookings: DataFrame | None = None  # A5 second booking table; None: the first one


class LazySources:
    """Same attributes as :class:`Sources`, each built on first use.

    Building a DataFrame is cheap but not free (the plan is analysed on the
    spot); a query that reads three inputs should not pay for fourteen.
    """

    NAMES = tuple(f.name for f in fields(Sources))

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        builders = {"econ_bookings": lambda: None, **builders}
        missing = set(self.NAMES) - set(builders)
        if missing:
            raise ValueError(f"no builder for {sorted(missing)}")
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._builders:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]
