"""Streams of events: sessions, tumbling and sliding windows, with a watermark for late rows. The same functions serve batch frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _late(df: DataFrame, delay: str) -> DataFrame:
    return df.withWatermark("ts", delay) if df.isStreaming else df


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Islands in time: a user's events less than ``gap`` apart."""
    g = _late(events, delay).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return g.select("user_id", "first_ts", "last_ts", "n")


def tumbling(events: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    g = _late(events, delay).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str = "2 hours", step: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    g = _late(events, delay).groupBy(F.window("ts", width, step).alias("w")).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), "n")
