"""Session settings the operators are tuned for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Adaptive execution sizes reduce partitions from measured map output, splits hot
# join partitions and switches to a broadcast only when the measured side is small.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sizes are compressed bytes, and copies of one row compress very well.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = 8, app: str = "starloom", **extra: str) -> SparkSession:
    """Session for tests and benchmarks; a cluster job brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    if "spark.checkpoint.dir" not in extra:
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="starloom-")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
