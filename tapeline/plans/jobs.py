"""The three jobs: feed to topic, topic to table, live view."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tapeline.operators.frames import (
    classify_frames,
    observe_kinds,
    quarantine_of,
    service_messages,
    trades_of,
)
from tapeline.operators.normalize import WINDOW_SECONDS
from tapeline.operators.records import (
    decode_records,
    decoded_trades,
    encode_records,
    observe_decode,
    rejected_records,
)
from tapeline.operators.subscriptions import DEFAULT_CHANNELS, subscribed_trades
from tapeline.operators.totals import window_totals
from tapeline.streaming.runs import start
from tapeline.streaming.sinks import BatchFunction, console_writer, topic_writer, with_row_ids

Totals = Callable[[DataFrame, int], DataFrame]


def feed_records(
    frames: DataFrame, channels: Sequence[str] | DataFrame | None = DEFAULT_CHANNELS
) -> DataFrame:
    """Feed frames to topic records: `key`, `value` for every trade of the channels.

    The channels are the default subscription unless others are given; None means all.
    """
    trades = trades_of(observe_kinds(classify_frames(frames)))
    if channels is not None:
        trades = subscribed_trades(trades, channels)
    return encode_records(trades)


def topic_trades(records: DataFrame) -> DataFrame:
    """Topic records to trades; records that hold none are counted and left out."""
    return decoded_trades(observe_decode(decode_records(records)))


def live_view(
    trades: DataFrame,
    checkpoint: str,
    *,
    period_seconds: int = WINDOW_SECONDS,
    rows: int = 50,
    totals: Totals = window_totals,
    **run: Any,
) -> StreamingQuery:
    """Trades to the console: the windows that changed, every 15 seconds.

    `totals` may be `stateful_totals`, for its rules on late trades.
    """
    writer = console_writer(totals(trades, period_seconds), rows)
    return start(trades.sparkSession, writer, checkpoint, **run)


def feed_to_topic(
    frames: DataFrame,
    sink: Callable[[DataFrame], DataStreamWriter],
    checkpoint: str,
    *,
    channels: Sequence[str] | DataFrame | None = DEFAULT_CHANNELS,
    **run: Any,
) -> StreamingQuery:
    """Feed frames to a topic; `sink` makes the writer, see `to_topic`."""
    writer = sink(feed_records(frames, channels))
    return start(frames.sparkSession, writer, checkpoint, **run)


def to_topic(
    servers: str, topic: str, **options: str | int
) -> Callable[[DataFrame], DataStreamWriter]:
    return lambda records: topic_writer(records, servers, topic, **options)


def topic_to_table(
    records: DataFrame,
    write: BatchFunction,
    checkpoint: str,
    *,
    period_seconds: int = WINDOW_SECONDS,
    totals: Totals = window_totals,
    **run: Any,
) -> StreamingQuery:
    """Topic records to a table, every 15 seconds.

    `write` is `append_to_log(path)`, or `append_to(format, ...)` for a table that replaces rows by
    key itself.
    """
    rows = with_row_ids(totals(topic_trades(records), period_seconds))
    writer = rows.writeStream.outputMode("update").foreachBatch(write)
    return start(records.sparkSession, writer, checkpoint, **run)


def set_aside(rejected: DataFrame, path: str, checkpoint: str, **run: Any) -> StreamingQuery:
    """Keep malformed frames or records, as they came, or service messages, in a Parquet folder.

    A query of its own: the totals have one output, and this one needs no state. Start it next
    to a job on the same source, or now and then with `once=True`.
    """
    writer = (
        rejected.withColumn("seen_at", F.current_timestamp())
        .writeStream.format("parquet")
        .option("path", path)
        .outputMode("append")
    )
    return start(rejected.sparkSession, writer, checkpoint, **run)


def malformed_frames(frames: DataFrame) -> DataFrame:
    return quarantine_of(classify_frames(frames))


def malformed_records(records: DataFrame) -> DataFrame:
    return rejected_records(decode_records(records))


def service_frames(frames: DataFrame) -> DataFrame:
    """Start messages and refused keys of the feed, to be kept with `set_aside`."""
    return service_messages(classify_frames(frames))
