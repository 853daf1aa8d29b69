"""Bar series seen in an event table (event_id, ts, user_id, event_type, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Naming the columns spares a job that opens files to find them.
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def tick_series(events: DataFrame) -> DataFrame:
    """One series per user: every event is a bar."""
    return events.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("Symbol"),
        F.col("ts").alias("BarDateTime"),
        F.col("value").alias("ClosePrice"),
    )


def hourly_bars(events: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """One series per event type: open, high, low, close and volume of each hour.

    ``start`` and ``end`` name the first and the last hour wanted. They restate the filter
    on the raw times, because a filter on the hour cannot reach the parquet scan.
    """
    if start is not None:
        events = events.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        past = F.lit(end).cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")
        events = events.where(F.col("ts") < past)
    place = F.struct("ts", "event_id")  # events of one time in a fixed order
    return (
        events.groupBy(
            F.upper("event_type").alias("Symbol"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("BarDateTime"),
        )
        .agg(
            F.min_by("value", place).alias("OpenPrice"),
            F.max("value").alias("HighPrice"),
            F.min("value").alias("LowPrice"),
            F.max_by("value", place).alias("ClosePrice"),
            F.count(F.lit(1)).alias("Volume"),
        )
    )
