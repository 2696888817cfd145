"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. Cluster sizing (executors, memory, number of
# shuffle partitions) is left to the submitter; AQE coalesces or splits them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Left joins that share one placement are split too, at the price of a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call sites in error messages cost a walk of the stack per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; a cluster job brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("funnelloom")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """Fresh folder that the driver and all executors see.

    ``spark.checkpoint.dir`` names the cluster's shared folder; where it is unset the
    folder lies in the warehouse, which a cluster shares as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
