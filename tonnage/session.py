"""A session with the settings that counts and digests rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI, adaptive execution; the number of shuffle partitions is left to the cluster unless given."""
    builder = SparkSession.builder.appName("tonnage")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # the JVM never compiles a method of more than 8000 bytes; wide projections are then better off in pieces
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    for key, value in (settings | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
