"""Bench: headline queries of the slate at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query starts from the driver tables. ``cold`` has its first run in a
warm JVM; ``queries`` the median of $BENCH_REPS further runs; ``value`` is
their sum. A run is timed end to end: plan, lookup checks, and a full
evaluation through the ``noop`` sink. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martspark.plans.session import local_session  # noqa: E402
from martspark.plans.slate import QUERIES  # noqa: E402

HEADLINE = [
    "kpi_monthly",
    "promo_daily",
    "month_rollup",
    "spine_left_join",
    "daily_economics",
    "paid_ads_daily",
    "aov_bands_pivot",
    "promo_class_pivot",
    "fulfilment_ops",
    "weighted_rating",
    "outlet_bridge",
    "restaurant_dim_enriched",
    "multi_distinct_rollup",
    "fx_convert_by_year",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    elapsed = time.perf_counter() - t0
    spark.catalog.clearCache()  # every timed run starts from the parquet files
    return elapsed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", "16")))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    run_once(spark, "kpi_monthly", sf_dir)  # JVM / codegen warm-up
    times, cold = {}, {}
    for name in names:
        cold[name] = round(run_once(spark, name, sf_dir), 3)
        times[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(reps)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "slate_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "reps": reps,
        "cold": cold,
        "cold_total_sec": round(sum(cold.values()), 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
