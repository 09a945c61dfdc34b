"""Keep the trades of subscribed channels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.functions.trades import event_time

# The channels subscribed to by default, as type~market~coin~currency.
DEFAULT_CHANNELS = (
    "0~Coinbase~BTC~USD",
    "0~Binance~BTC~USDT",
    "0~Kraken~BTC~USD",
    "0~CoinDeal~BTC~USD",
    "0~Gemini~BTC~USD",
)

# The longest time for which one subscription holds.
LONGEST = "1 day"
WATERMARK = "5 minutes"

_CHANNEL = ["M", "FSYM", "TSYM"]
_TRADES = "0"


def channel_table(channels: DataFrame) -> DataFrame:
    """Trade channels (column `channel`) as distinct market, coin and currency.

    Channels of another type than trades, and names without four parts, match nothing.
    """
    return _named(channels).select(*_CHANNEL).distinct()


def _named(channels: DataFrame) -> DataFrame:
    """Rows whose `channel` is one of trades, with market, coin and currency added."""
    part = F.split("channel", "~")
    named = channels.where(F.size(part) == 4).select(
        "*",
        F.get(part, F.lit(0)).alias("_type"),
        *[F.get(part, F.lit(i + 1)).alias(name) for i, name in enumerate(_CHANNEL)],
    )
    whole = " AND ".join(f"{name} <> ''" for name in _CHANNEL)
    return named.where(f"_type = '{_TRADES}' AND {whole}").drop("_type")


def subscribed_trades(trades: DataFrame, channels: Sequence[str] | DataFrame) -> DataFrame:
    """Trades whose market, coin and currency are in `channels`.

    A semi join without hints: Spark broadcasts the channels if its own threshold allows it, and
    otherwise shuffles both sides and splits the partition of a hot market when it sees its size.
    A name in a list of names that does not have four parts is an error.
    """
    if not isinstance(channels, DataFrame):
        names = sorted(set(channels))
        broken = [name for name in names if len([p for p in name.split("~") if p]) != 4]
        if broken:
            raise ValueError(f"not type~market~coin~currency: {broken}")
        # From Arrow, so that the planner knows its size.
        named = pa.table({"channel": pa.array(names, pa.string())})
        channels = trades.sparkSession.createDataFrame(named)
    return trades.join(channel_table(channels), _CHANNEL, "left_semi").select(*trades.columns)


def subscribed_at(
    trades: DataFrame,
    subscriptions: DataFrame,
    *,
    longest: str = LONGEST,
    watermark: str = WATERMARK,
    buckets: int = 1,
) -> DataFrame:
    """Trades whose channel was subscribed to at the trade's own time; both sides may be streams.

    `subscriptions`: `channel`, `valid_from` and `valid_to` (timestamps; the second is not part of the
    period, and null stands for as long as there may be). No period is longer than `longest`; a channel that is
    needed for longer is subscribed to again, and periods may overlap. A trade is kept once.

    On streams, a trade waits in state until the watermark of the subscriptions is past it, as a period may
    still come that has begun by then, and a period until the watermark of the trades is past its longest
    end. Append mode, as for records of a topic. A hot channel has one period per subscription and bucket in
    state, its trades are those since the watermark.

    Two streams are joined by channel, so a channel's trades wait in one task. With `buckets` they are
    dealt out to that many by id and time, and every bucket has a copy of the channel's periods: have a few
    per task of the shuffle where there are few channels for the trades. Never change their number under a
    checkpoint; with one, checkpoints are as they were before there were buckets.
    """
    at = F.expr(f"valid_from + INTERVAL {longest}")
    periods = _named(subscriptions).select(
        *[F.col(name).alias(f"_{name}") for name in _CHANNEL],
        F.col("valid_from").alias("_from"),
        F.least(F.coalesce("valid_to", at), at).alias("_to"),
    )
    timed = trades.withColumn("_at", event_time(F.col("TS")))
    if subscriptions.isStreaming:
        periods = periods.withWatermark("_from", watermark)
    if trades.isStreaming:
        timed = timed.withWatermark("_at", watermark)
    same = [F.col(name) == F.col(f"_{name}") for name in _CHANNEL]
    # Only state has to be spread: a batch's hot partition is split, or its periods are broadcast.
    if buckets > 1 and subscriptions.isStreaming and trades.isStreaming:
        dealt_by = [name for name in ("ID", "TS") if name in trades.columns]
        timed = timed.withColumn("_bucket", F.pmod(F.xxhash64(*dealt_by), F.lit(buckets)))
        numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint"))
        periods = periods.withColumn("_copy", F.explode(numbers))
        same.append(F.col("_bucket") == F.col("_copy"))
    inside = (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to"))
    # Follows from the above; it tells until when a period has to be kept.
    bound = F.col("_at") < F.col("_from") + F.expr(f"INTERVAL {longest}")
    condition = reduce(lambda x, y: x & y, [*same, inside, bound])
    return timed.join(periods, condition, "left_semi").select(*trades.columns)
