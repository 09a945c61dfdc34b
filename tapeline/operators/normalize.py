"""Trade rows to normalised trades: side, event time, names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.functions.trades import event_time, has_side, side_label, window_of

WINDOW_SECONDS = 60


def keep_sides(trades: DataFrame) -> DataFrame:
    """Buys and sells only."""
    return trades.where(has_side(F.col("F")))


def normalize_trades(trades: DataFrame) -> DataFrame:
    return trades.select(
        F.col("ID").alias("id"),
        F.col("FSYM").alias("fromcoin"),
        F.col("TSYM").alias("tocurrency"),
        F.col("M").alias("market"),
        side_label(F.col("F")).alias("direction"),
        event_time(F.col("TS")).alias("timestamp"),
        F.col("Q").alias("quantity"),
        F.col("TOTAL").alias("vol"),
        F.col("P").alias("price"),
    )


def assign_window(normalized: DataFrame, period_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Add `window_start` and `window_end`."""
    window = window_of(F.col("timestamp"), period_seconds)
    return (
        normalized.withColumn("_window", window)
        .withColumn("window_start", F.col("_window.start"))
        .withColumn("window_end", F.col("_window.end"))
        .drop("_window")
    )
