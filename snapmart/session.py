"""Session settings the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Adaptive execution picks join sides by measured size, merges small
    # shuffle partitions and splits skewed ones; no join is forced by a hint.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keep splitting a hot join key even when that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Periods are text: "202501", never the integer 202501.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Overwriting touches only the partitions present in the data.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Conforming a wide raw file makes large generated methods. Above 8000 bytes
    # the JVM never compiles them; Spark then generates smaller pieces instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def builder(app_name: str = "snapmart") -> SparkSession.Builder:
    """A session builder carrying the package settings; the caller adds the
    master, memory and ``spark.sql.shuffle.partitions`` for its cluster."""
    b = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else created.

    This changes that session for all its users: among others its time zone (UTC) and
    the overwrite mode of partitioned writes (dynamic).
    """
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark
