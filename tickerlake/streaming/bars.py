"""Daily OHLCV bars from ticks, batch and streaming with one definition.

The aggregate is a plain grouped aggregation (partial-aggregated before the
shuffle, so a hot symbol costs one partial row per task).  The streaming
form adds an event-time watermark and a one-day tumbling window; in append
mode a day's bar is emitted once the watermark passes the day's end, and
the state of closed days is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def _bar_aggs(price: str, order: str) -> list[Column]:
    return [
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    ]


def daily_bars(ticks: DataFrame, symbol: str = "event_type", ts: str = "ts",
               price: str = "value", order: str = "event_id") -> DataFrame:
    """Batch: one bar per (symbol, calendar day of ``ts``); open/close by ``order``."""
    return (ticks.groupBy(F.col(symbol).alias("symbol"), F.to_date(ts).alias("price_date"))
            .agg(*_bar_aggs(price, order)))


def event_time(ts: Column) -> Column:
    """TIMESTAMP_NTZ wall clock (taken as UTC) -> TIMESTAMP, independent of the session zone.

    Watermarks need a TIMESTAMP column; a plain cast would read the wall
    clock in the session time zone and shift the day windows.
    """
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp")


def stream_bars(ticks: DataFrame, delay: str = "1 day", symbol: str = "event_type", ts: str = "ts",
                price: str = "value", order: str = "event_id") -> DataFrame:
    """Streaming: closed daily bars with a ``delay`` watermark (append mode).

    ``ts`` may be TIMESTAMP_NTZ (a UTC wall clock) or TIMESTAMP (an instant).
    """
    is_ntz = isinstance(ticks.schema[ts].dataType, TimestampNTZType)
    t = ticks.withColumn("_et", event_time(F.col(ts)) if is_ntz else F.col(ts))
    return (t.withWatermark("_et", delay)
            .groupBy(F.col(symbol).alias("symbol"), F.window("_et", "1 day").alias("w"))
            .agg(*_bar_aggs(price, order))
            .select("symbol",
                    F.to_date(F.convert_timezone(F.current_timezone(), F.lit("UTC"),
                                                 F.col("w.start").cast("timestamp_ntz"))).alias("price_date"),
                    "open", "high", "low", "close", "volume"))
