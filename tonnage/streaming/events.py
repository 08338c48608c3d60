"""Structured Streaming over event files: late data by watermark, windows, sessions, de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])


def read_events(spark: SparkSession, path: str, schema: T.StructType = EVENTS, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def tumbling(events: DataFrame, every: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts and sums by window and type; a window closes when the watermark has passed its end."""
    found = events.withWatermark("ts", late).groupBy(F.window("ts", every), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return found.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    found = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return found.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(events: DataFrame, key: str = "event_id", late: str = "1 day") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def to_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what there is, once; a restart goes on from the checkpoint."""
    return stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
