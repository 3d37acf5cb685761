"""Structured Streaming forms of the outreach log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """The events table as a stream of files."""
    return spark.readStream.schema(EVENTS).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and their sum by window and type, batch or stream; rows later than `late` are dropped in a stream."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type")
    return w.agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def user_sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of users: runs of events with gaps below `gap`."""
    s = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return s.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """One row an event id within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def drained(df: DataFrame, name: str) -> DataFrame:
    """Runs a stream over all that is there and returns its rows, for tests and small checks."""
    q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)
