"""A session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution splits skewed joins, merges small partitions and turns a
# join into a broadcast once the real size is known to pass the threshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(
    cores: int | str = "*", *, shuffle_partitions: int = 8, memory: str = "8g", **settings: str
) -> SparkSession:
    """For tests and the benchmark; a cluster job brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("barloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
