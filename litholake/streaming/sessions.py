"""Structured Streaming over the event table: an extension, the reference has no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet files of events as they arrive in ``folder``; their naive timestamps are taken as session-zone time."""
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    return spark.readStream.schema(schema).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def sessions(events: DataFrame, gap: str = "1 hour", late: str = "30 days") -> DataFrame:
    """Sessions per type and user; an event that comes later than ``late`` behind the watermark is dropped. Repeated
    deliveries of an event within that span count once."""
    once = events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    return once.groupBy("event_type", "user_id", F.session_window("ts", gap).alias("w")).agg(F.max("ts").alias("last"), F.count("*").alias("n")).select("event_type", "user_id", F.col("w.start").alias("start"), "last", "n")


def tumbling(events: DataFrame, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts and sums per type and window."""
    return events.withWatermark("ts", late).groupBy("event_type", F.window("ts", width).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("event_type", F.col("w.start").alias("start"), "n", "total")


def ingest_metadata(spark: SparkSession, folder: str, table_path: str, checkpoint: str):
    """New metadata files appended once each to a parquet table, all that is there now. S11, S16 as a stream."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.json").load(folder)
    rows = files.select("path", "modificationTime", F.decode("content", "UTF-8").alias("metadata"))
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", table_path).trigger(availableNow=True).start()
