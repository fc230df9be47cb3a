"""Session settings the marts rely on.

On a cluster the session is built by the platform; ``tune`` only sets
what is unset and never touches cluster-wide choices such as the
checkpoint folder when the cluster names one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the plans are written for. AQE re-plans joins from measured
# stage sizes, splits skewed partitions and coalesces small ones.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Semi-join reduction sized for a month of bookings: the month's order
    # keys prune the full economics history in its scan before the shuffle
    # of the left join (the largest exchange of the KPI mart at scale).
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "200000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "1073741824",
    "spark.sql.parquet.filterPushdown": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in PLAN_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for scratch tables, read from ``spark.checkpoint.dir``.

    Where the cluster names none (tests), the context gets a local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="martspark-scratch-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def local_session(cores: str = "*", shuffle_partitions: int = 8,
                  app: str = "martspark") -> SparkSession:
    """Session for tests and the local bench (UI off, UTC session zone)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("MARTSPARK_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in PLAN_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
