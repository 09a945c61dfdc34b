"""Totals per market, coin, side and window: the native form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.functions.trades import date_bucket, window_of
from tapeline.operators.normalize import WINDOW_SECONDS, keep_sides, normalize_trades
from tapeline.schemas import TOTALS

WATERMARK = "5 minutes"
CURRENCY = "USD"


def total_columns(windowed: DataFrame, currency: str = CURRENCY) -> DataFrame:
    """Finish rows that have the window, the key and the four totals.

    The currency is a label for the whole result, whatever the trades were quoted in.
    """
    return (
        windowed.withColumn("date", date_bucket(F.col("window_end")))
        .withColumn("tocurrency", F.lit(currency))
        .select(*TOTALS.fieldNames())
    )


def window_totals(
    trades: DataFrame,
    period_seconds: int = WINDOW_SECONDS,
    *,
    watermark: str = WATERMARK,
    currency: str = CURRENCY,
    max_partitions: int | None = None,
) -> DataFrame:
    """Volume, mean price, quantity and count per market, coin, side and window.

    One shuffle, and only of partial results: every task first combines its own trades, so a
    market with a third of all trades sends one row per window and task. On a stream the
    state is one row of sums per open group; it is dropped once the watermark passes the end of
    the window, and a late trade still counts until then. Duplicates count.
    """
    if max_partitions is not None:
        trades = trades.coalesce(max_partitions)
    normalized = normalize_trades(keep_sides(trades)).withWatermark("timestamp", watermark)
    window = window_of(F.col("timestamp"), period_seconds).alias("window")
    totals = normalized.groupBy("market", "fromcoin", "direction", window).agg(
        F.sum("vol").alias("totalvol"),
        F.avg("price").alias("avgprice"),
        F.sum("quantity").alias("totalquantity"),
        F.count("*").alias("counttxns"),
    )
    return total_columns(
        totals.select(
            "*",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
        ),
        currency,
    )
