"""Session settings for large inputs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Sizes for executors with about 4 GB per core; the number of shuffle partitions
# is a ceiling that adaptive execution merges down to the advisory size.
LARGE_INPUT_SETTINGS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.parquet.filterPushdown": "true",
}

# Wide projections can fuse into generated methods above the size the JVM
# compiles by default; read at JVM start, so set it where the session is launched.
COMPILE_LONG_METHODS = "-XX:-DontCompileHugeMethods"


def with_large_input_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    return builder.config(map=LARGE_INPUT_SETTINGS).config(
        "spark.executor.extraJavaOptions", COMPILE_LONG_METHODS
    )
