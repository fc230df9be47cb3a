"""martspark: merchant-performance marts on Spark DataFrames.

Layout
------
functions/  calendar windows, local dates, classification CASEs, FX money
sources/    explicit input schemas and adapters from the driver tables
operators/  dimensions, type-2 history, daily branches, spine joins, checks
plans/      the two marts, join helpers, session settings
streaming/  re-runnable month refresh of a mart (the only late-data rule)
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
