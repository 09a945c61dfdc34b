"""

Sums of doubles differ in their last digits with the order of addition, between engines and between
runs. All amounts are in whole cents, so the totals are rounded to cents here, and the mean is taken
again from its total in cents; the SQL adds decimals. Time zone is UTC on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.functions.trades import date_bucket
from tapeline.functions.uuids import time_uuid, uuid_millis
from tapeline.operators.frames import classify_frames, count_kinds, quarantine_of, service_messages, trades_of
from tapeline.operators.normalize import assign_window, keep_sides, normalize_trades
from tapeline.operators.records import decode_records, decoded_trades, encode_records
from tapeline.operators.served import as_totals, latest_rows, rows_of_date, rows_of_windows
from tapeline.operators.subscriptions import subscribed_at, subscribed_trades
from tapeline.operators.totals import window_totals
from tapeline.plans.jobs import feed_to_topic, topic_to_table
from tapeline.schemas import TOTALS, TRADE
from tapeline.sources.files import read_lines, read_trades
from tapeline.sources.pushed import push_rows, pushed_trades
from tapeline.sources.tables import (
    events_as_frames,
    events_as_records,
    events_as_trades,
    lineitem_as_trades,
)
from tapeline.streaming.accounts import Accounts, batch_accounts, observe_sides, read_counts
from tapeline.streaming.runs import STATE_SETTINGS, run_for, start, work_folder
from tapeline.streaming.sinks import (
    append_to_log,
    drop_folded,
    fold_log,
    keep_table,
    read_log,
    read_served,
    read_table,
    with_row_ids,
)
from tapeline.streaming.stateful import stateful_totals
from tapeline.streaming.states import open_groups

HOUR = 3_600
DAY = 86_400
DECADE = 3650 * DAY
SERVED_DAY = "2024-01-02"
SERVED_WINDOWS = ("2024-01-02 18:00:00", "2024-01-04 06:00:00")
# The last is not a channel of trades and matches nothing.
CHANNELS = ("0~Coinbase~BTC~USD", "0~Binance~BTC~USDT", "0~Gemini~BTC~USD", "2~Kraken~BTC~USD")

Query = Callable[[SparkSession, str], DataFrame]

try:
    import corpus_pipeline
    from tapeline.llm import queries as llm
except ModuleNotFoundError as missing:
    # The operators for training data are a part that can be left out, and is where their vocabulary
    # files are not installed.
    if missing.name not in ("corpus_pipeline", "tapeline.llm", "public_tokenizers"):
        raise
    llm = None


# --- tables ---------------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def _event_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_trades(_events(spark, sf_dir))


def _line_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_as_trades(_table(spark, sf_dir, "lineitem"))


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream. A streaming read wants a pattern even for a single file."""
    schema = _table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet")


# --- result shapes --------------------------------------------------------------------------


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the oracle has them."""
    return df.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def _rounded(totals: DataFrame) -> DataFrame:
    price_total = F.round(F.col("avgprice") * F.col("counttxns"), 2)
    return _plain(
        totals.withColumn("totalvol", F.round("totalvol", 2))
        .withColumn("totalquantity", F.round("totalquantity", 2))
        .withColumn("avgprice", price_total / F.col("counttxns"))
    )


def _streamed(spark: SparkSession, totals: DataFrame, name: str) -> DataFrame:
    """Run a stream of totals over all there is, into a change log; the latest row per key."""
    log = work_folder(spark, f"{name}-log")
    writer = with_row_ids(totals).writeStream.outputMode("update").foreachBatch(append_to_log(log))
    start(spark, writer, work_folder(spark, f"{name}-state"), once=True).awaitTermination()
    return as_totals(latest_rows(read_log(spark, log)))


# --- row operators --------------------------------------------------------------------------


def side_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_sides(_event_trades(spark, sf_dir)).select("ID", "F")


def trade_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(normalize_trades(_event_trades(spark, sf_dir)))


def window_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    windowed = assign_window(normalize_trades(_event_trades(spark, sf_dir)))
    return _plain(windowed.select("id", "timestamp", "window_start", "window_end"))


def date_bucket_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    windowed = assign_window(normalize_trades(_event_trades(spark, sf_dir)), HOUR)
    return _plain(
        windowed.select("id", "window_end", date_bucket(F.col("window_end")).alias("date"))
    )


def row_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids made from the event's own time, read back: version, variant and time."""
    events = _events(spark, sf_dir)
    made = events.select(
        "event_id",
        time_uuid(F.unix_millis(F.col("ts").cast("timestamp")), F.col("event_id")).alias("uuid"),
    )
    return made.select(
        "event_id",
        F.length("uuid").cast("bigint").alias("uuid_length"),
        F.substring("uuid", 15, 1).alias("uuid_version"),
        F.substring("uuid", 20, 1).isin("8", "9", "a", "b").alias("uuid_variant_ok"),
        uuid_millis(F.col("uuid")).alias("uuid_millis"),
    )


# --- totals ---------------------------------------------------------------------------------


def trade_window_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(window_totals(_event_trades(spark, sf_dir)))


def trade_window_agg_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(window_totals(_event_trades(spark, sf_dir), HOUR))


def trade_window_agg_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(window_totals(_line_trades(spark, sf_dir), DAY))


def trade_window_agg_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = events_as_trades(_stream(spark, sf_dir, "events"))
    return _rounded(_streamed(spark, window_totals(trades), "totals"))


def trade_window_agg_stream_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = lineitem_as_trades(_stream(spark, sf_dir, "lineitem"))
    return _rounded(_streamed(spark, window_totals(trades, DAY), "daily"))


def narrow_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of trades that are first brought into two partitions."""
    return _rounded(window_totals(_line_trades(spark, sf_dir), DAY, max_partitions=2))


def bounded_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query on an interval, with a shuffle width of its own, stopped after its time."""
    log, state = work_folder(spark, "bounded-log"), work_folder(spark, "bounded-state")
    totals = window_totals(events_as_trades(_stream(spark, sf_dir, "events")))
    writer = with_row_ids(totals).writeStream.outputMode("update").foreachBatch(append_to_log(log))
    query = start(spark, writer, state, interval="1 second", shuffle_partitions=3)
    query.processAllAvailable()
    ended = run_for(query, 1)
    (width,) = spark.read.format("state-metadata").load(state).select("numPartitions").first()
    return _rounded(as_totals(latest_rows(read_log(spark, log)))).select(
        "*",
        F.lit(width).cast("bigint").alias("state_partitions"),
        F.lit(not ended and not query.isActive).alias("stopped"),
    )


def _buckets(spark: SparkSession) -> int:
    """A few buckets per task of the shuffle. Each run has its own checkpoint, so this may vary."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def trade_window_agg_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = events_as_trades(_stream(spark, sf_dir, "events"))
    totals = stateful_totals(trades, buckets=_buckets(spark))
    return _rounded(_streamed(spark, totals, "stateful"))


def trade_window_agg_stateful_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = lineitem_as_trades(_stream(spark, sf_dir, "lineitem"))
    totals = stateful_totals(trades, DAY, buckets=_buckets(spark))
    return _rounded(_streamed(spark, totals, "stateful-daily"))


def _run_slices(
    spark: SparkSession, sf_dir: str, make: Callable, held: str = "false"
) -> tuple[str, str]:
    """Totals of the events in four micro-batches, each a run of its own from one checkpoint: log, checkpoint.

    Batches without trades are off, as one of them would make the stateful variant forget the groups
    of the slice before. Ids are in the order of time. Trades for which `held` holds come only with the last slice, long
    after the watermark has passed them; the last slice also has on-time trades of its own.
    """
    trades = events_as_trades(_events(spark, sf_dir), keep=("event_id",))
    n = trades.agg(F.max("event_id")).first()[0] + 1
    turn = F.when(F.expr(held), 3).otherwise(F.floor(F.col("event_id") * 4 / n)).cast("int")
    cut = trades.withColumn("_slice", turn)
    landing, log, state = (work_folder(spark, f"slices-{x}") for x in ("in", "log", "state"))
    for i in range(4):
        some = cut.where(F.col("_slice") == i).select(*TRADE.fieldNames())
        some.write.mode("append").parquet(landing)
        totals = make(read_trades(spark, landing, file_format="parquet"))
        writer = with_row_ids(totals).writeStream.outputMode("update")
        writer = writer.foreachBatch(append_to_log(log))
        settings = {**STATE_SETTINGS, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
        start(spark, writer, state, once=True, state_settings=settings).awaitTermination()
    return log, state


def _slices(
    spark: SparkSession, sf_dir: str, make: Callable, held: str = "false"
) -> DataFrame:
    log, _ = _run_slices(spark, sf_dir, make, held)
    return _rounded(as_totals(latest_rows(read_log(spark, log))))


def _open_after_slices(spark: SparkSession, sf_dir: str, make: Callable) -> DataFrame:
    """What the state holds after the last of the slices, read back from the checkpoint."""
    _, state = _run_slices(spark, sf_dir, make)
    found = open_groups(spark, state)
    labelled = found.withColumn("date", date_bucket(F.col("window_end")))
    return _rounded(labelled.withColumn("tocurrency", F.lit("USD")).select(*TOTALS.fieldNames()))


def _accounts(spark: SparkSession, sf_dir: str, make: Callable) -> DataFrame:
    """Trades of every slice by what became of them; the last slice has trades of windows long closed."""
    folder = work_folder(spark, "accounts")
    listener = Accounts(spark, folder)
    spark.streams.addListener(listener)
    try:
        log, _ = _run_slices(spark, sf_dir, lambda t: make(observe_sides(t)), _held(spark, sf_dir))
        listener.wait()
    finally:
        spark.streams.removeListener(listener)
    found = batch_accounts(read_counts(spark, folder), read_log(spark, log))
    # How many partial sums the late trades were in depends on tasks.
    return found.withColumn("dropped", F.col("late_partials") > 0).drop("late_partials")


def late_accounts_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accounts(spark, sf_dir, window_totals)


def late_accounts_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accounts(spark, sf_dir, lambda t: stateful_totals(t, buckets=_buckets(spark)))


def held_groups_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that the watermark of the last slice has not passed."""
    return _open_after_slices(spark, sf_dir, window_totals)


def held_groups_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups that the last slice changed; all others have been forgotten by then."""
    make = lambda t: stateful_totals(t, buckets=_buckets(spark))
    return _open_after_slices(spark, sf_dir, make)


def _held(spark: SparkSession, sf_dir: str) -> str:
    """One in 13 of the first eighth of the ids, whose windows have long been closed at the end."""
    n = _events(spark, sf_dir).agg(F.max("event_id")).first()[0] + 1
    return f"event_id % 13 = 0 AND event_id < {n} / 8"


def slices_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slices(spark, sf_dir, window_totals)


def slices_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slices(spark, sf_dir, lambda t: stateful_totals(t, buckets=_buckets(spark)))


def late_open_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late trades of windows that are open, as they last ten years: taken."""
    return _slices(spark, sf_dir, lambda t: window_totals(t, DECADE), _held(spark, sf_dir))


def late_open_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trades, judged by their own time: dropped."""
    make = lambda t: stateful_totals(t, DECADE, buckets=_buckets(spark))
    return _slices(spark, sf_dir, make, _held(spark, sf_dir))


def late_closed_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late trades of closed windows: dropped."""
    return _slices(spark, sf_dir, window_totals, _held(spark, sf_dir))


def late_closed_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    make = lambda t: stateful_totals(t, buckets=_buckets(spark))
    return _slices(spark, sf_dir, make, _held(spark, sf_dir))


def trade_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored trades, some with a field missing or a time out of range, in two formats."""
    trades = events_as_trades(_events(spark, sf_dir), keep=("event_id",))
    broken = trades.withColumn("Q", F.when(F.col("event_id") % 7 != 0, F.col("Q"))).withColumn(
        "TS", F.when(F.col("event_id") % 11 == 0, 10**15 + F.col("TS")).otherwise(F.col("TS"))
    )
    read = []
    for file_format in ("json", "parquet"):
        path = work_folder(spark, f"accept-{file_format}")
        broken.select(*TRADE.fieldNames()).write.format(file_format).save(path)
        some = read_trades(spark, path, file_format=file_format, stream=False)
        read.append(_rounded(window_totals(some, HOUR)).withColumn("format", F.lit(file_format)))
    return read[0].unionByName(read[1])


# --- frames and records ---------------------------------------------------------------------


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_frames(events_as_frames(_events(spark, sf_dir)))


def frame_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select("event_id", "kind")


def frame_kind_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_kinds(_classified(spark, sf_dir))


def frame_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = quarantine_of(_classified(spark, sf_dir))
    return kept.select(
        "event_id",
        "kind",
        F.col("value").startswith('{"TYPE":"0"').alias("raw_start"),
        F.col("value").endswith("}").alias("raw_closed"),
    )


def frame_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_of(_classified(spark, sf_dir))


def service_messages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service_messages(_classified(spark, sf_dir))


def kafka_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded_trades(decode_records(events_as_records(_events(spark, sf_dir))))


def kafka_encode_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per key."""
    keys = encode_records(_event_trades(spark, sf_dir))
    return keys.groupBy("key").agg(F.count("*").alias("records"))


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded_trades(decode_records(encode_records(_line_trades(spark, sf_dir))))


def subscription_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = subscribed_trades(_event_trades(spark, sf_dir), CHANNELS)
    return trades.select("ID", "M", "FSYM", "TSYM")


def subscription_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams: trades, and subscriptions of which one begins midway and one ends."""
    events = _events(spark, sf_dir)
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(seconds), F.max(seconds)).first()
    names = spark.createDataFrame([(name,) for name in CHANNELS], "channel string")
    middle = F.timestamp_seconds(F.lit((first + last) // 2))
    late, ended = F.col("channel").contains("Binance"), F.col("channel").contains("Gemini")
    periods = names.select(
        "channel",
        F.when(late, middle).otherwise(F.timestamp_seconds(F.lit(first - DAY))).alias("valid_from"),
        F.when(ended, middle).alias("valid_to"),
    )
    feed, topic = work_folder(spark, "subscriptions"), work_folder(spark, "subscribed")
    # Given twice, as if they had been renewed: a trade is kept once.
    for _ in range(2):
        periods.write.mode("append").parquet(feed)
    kept = subscribed_at(
        events_as_trades(_stream(spark, sf_dir, "events")),
        spark.readStream.schema(periods.schema).parquet(feed),
        longest="3650 days",
        buckets=_buckets(spark),
    )
    writer = kept.writeStream.format("parquet").option("path", topic)
    start(spark, writer, work_folder(spark, "subscribed-state"), once=True).awaitTermination()
    return spark.read.schema(TRADE).parquet(topic).select("ID", "M", "FSYM", "TSYM")


# --- sinks, serving, jobs -------------------------------------------------------------------


def _logged_totals(spark: SparkSession, sf_dir: str, parts: int = 1) -> list[str]:
    """Change logs of totals as trades come in: batch 0 has half of the trades, batch 1 has all and
    is run twice. With two parts each batch has a log of its own, as folded batches are dropped.

    The totals are stored first, so that they are computed once.
    """
    trades = _event_trades(spark, sf_dir)
    half = trades.where("CAST(ID AS BIGINT) % 2 = 0")
    logs = [work_folder(spark, "log") for _ in range(parts)]
    for batch_id, some in ((0, half), (1, trades), (1, trades)):
        stored = work_folder(spark, "totals")
        window_totals(some).write.parquet(stored)
        totals = spark.read.schema(TOTALS).parquet(stored).withColumn("uuid", F.lit(""))
        rows = totals.withColumn("batch_ms", F.lit(1000 * batch_id).cast("bigint"))
        append_to_log(logs[min(batch_id, parts - 1)])(rows, batch_id)
    return logs


def sink_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    (log,) = _logged_totals(spark, sf_dir)
    return _rounded(as_totals(latest_rows(read_log(spark, log))))


def serve_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folds with the folded batch dropped between them; the second changes some rows only."""
    table = work_folder(spark, "table")
    log, later = _logged_totals(spark, sf_dir, parts=2)
    drop_folded(spark, log, fold_log(spark, log, table))
    fold_log(spark, later, table, "0001-01-01", SERVED_DAY)
    return _rounded(as_totals(rows_of_date(read_table(spark, table, SERVED_DAY), SERVED_DAY)))


def serve_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of windows over three dates, from a table folded twice."""
    table = work_folder(spark, "table")
    log, later = _logged_totals(spark, sf_dir, parts=2)
    fold_log(spark, log, table)
    fold_log(spark, later, table)
    return _rounded(as_totals(rows_of_windows(read_table(spark, table), *SERVED_WINDOWS)))


def trade_file_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder of trades as JSON lines, streamed to totals."""
    landing = work_folder(spark, "landing")
    encode_records(_line_trades(spark, sf_dir)).select("value").write.text(landing)
    return _rounded(_streamed(spark, window_totals(read_trades(spark, landing), DAY), "files"))


def trade_push_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades pushed in three appends; the query is started again after each from its checkpoint."""
    trades = events_as_trades(_events(spark, sf_dir), keep=("event_id",))
    n = trades.agg(F.max("event_id")).first()[0] + 1
    feed, log, state = (work_folder(spark, f"push-{x}") for x in ("feed", "log", "state"))
    for i in range(3):
        part = trades.where(F.floor(F.col("event_id") * 3 / n) == i)
        push_rows(part.select(*TRADE.fieldNames()), feed)
        totals = with_row_ids(window_totals(pushed_trades(spark, feed)))
        writer = totals.writeStream.outputMode("update").foreachBatch(append_to_log(log))
        start(spark, writer, state, once=True).awaitTermination()
    return _rounded(as_totals(latest_rows(read_log(spark, log))))


def topic_to_table_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with broken values among them, through decoding, totals and the table."""
    records = events_as_records(_stream(spark, sf_dir, "events"))
    log, table = work_folder(spark, "job-log"), work_folder(spark, "job-table")
    state = work_folder(spark, "job-state")
    write = keep_table(log, table, every=1)
    topic_to_table(records, write, state, once=True).awaitTermination()
    return _rounded(as_totals(read_served(spark, log, table)))


def feed_to_topic_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder of frames to records, then totals of those records.

    The records go to files, as there is no topic here.
    """
    frames, topic = work_folder(spark, "frames"), work_folder(spark, "topic")
    events_as_frames(_events(spark, sf_dir)).select("value").write.text(frames)
    feed_to_topic(
        read_lines(spark, frames),
        lambda records: records.writeStream.format("parquet").option("path", topic),
        work_folder(spark, "feed-state"),
        channels=CHANNELS,
        once=True,
    ).awaitTermination()
    records = spark.read.schema("key string, value string").parquet(topic)
    return _rounded(window_totals(decoded_trades(decode_records(records)), HOUR))


# --- contract -------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Windowed totals of the trades in the smallest events table."""
    return trade_window_agg(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    training = {} if llm is None else {**llm.queries(), "pipeline": corpus_pipeline.run}
    return {
        **training,
        "side_filter": side_filter,
        "trade_normalize": trade_normalize,
        "window_assign": window_assign,
        "date_bucket": date_bucket_query,
        "row_uuid": row_uuid,
        "trade_window_agg": trade_window_agg,
        "trade_window_agg_hourly": trade_window_agg_hourly,
        "trade_window_agg_lineitem": trade_window_agg_lineitem,
        "trade_window_agg_stream": trade_window_agg_stream,
        "trade_window_agg_stream_lineitem": trade_window_agg_stream_lineitem,
        "trade_window_agg_stateful": trade_window_agg_stateful,
        "trade_window_agg_stateful_lineitem": trade_window_agg_stateful_lineitem,
        "narrow_partitions": narrow_partitions,
        "bounded_run": bounded_run,
        "slices_native": slices_native,
        "slices_stateful": slices_stateful,
        "late_accounts_native": late_accounts_native,
        "late_accounts_stateful": late_accounts_stateful,
        "held_groups_native": held_groups_native,
        "held_groups_stateful": held_groups_stateful,
        "late_open_native": late_open_native,
        "late_open_stateful": late_open_stateful,
        "late_closed_native": late_closed_native,
        "late_closed_stateful": late_closed_stateful,
        "trade_acceptance": trade_acceptance,
        "service_messages": service_messages_query,
        "frame_classify": frame_classify,
        "frame_kind_counts": frame_kind_counts,
        "frame_quarantine": frame_quarantine,
        "frame_trades": frame_trades,
        "kafka_decode": kafka_decode,
        "kafka_encode_key": kafka_encode_key,
        "json_roundtrip": json_roundtrip,
        "subscription_filter": subscription_filter,
        "subscription_added": subscription_added,
        "sink_latest": sink_latest,
        "serve_by_date": serve_by_date,
        "serve_windows": serve_windows,
        "trade_file_stream": trade_file_stream,
        "trade_push_stream": trade_push_stream,
        "topic_to_table": topic_to_table_job,
        "feed_to_topic": feed_to_topic_job,
    }


_EVENT_TRADES = """
    SELECT event_id, event_type, '0' AS "TYPE",
           ['Coinbase', 'Binance', 'Kraken', 'CoinDeal', 'Gemini'][user_id % 5 + 1] AS "M",
           'BTC' AS "FSYM",
           CASE WHEN user_id % 5 = 1 THEN 'USDT' ELSE 'USD' END AS "TSYM",
           CASE event_type WHEN 'purchase' THEN '1' WHEN 'click' THEN '2' ELSE '4' END AS "F",
           CAST(event_id AS VARCHAR) AS "ID",
           epoch_us(ts) // 1000000 AS "TS",
           CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS "Q",
           value AS "P",
           CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) * value AS "TOTAL",
           epoch_us(ts) // 1000000 AS "RTS"
    FROM events
"""

_LINE_TRADES = """
    SELECT '0' AS "TYPE",
           ['Coinbase', 'Binance', 'Kraken', 'CoinDeal', 'Gemini'][l_suppkey % 5 + 1] AS "M",
           'BTC' AS "FSYM",
           CASE WHEN l_suppkey % 5 = 1 THEN 'USDT' ELSE 'USD' END AS "TSYM",
           CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '2' ELSE '4' END AS "F",
           l_orderkey || '-' || l_linenumber AS "ID",
           epoch_us(l_shipdate) // 1000000 AS "TS",
           l_quantity AS "Q",
           l_extendedprice AS "P",
           l_quantity * l_extendedprice AS "TOTAL",
           epoch_us(l_shipdate) // 1000000 AS "RTS"
    FROM lineitem
"""

_TRADE_COLUMNS = '"TYPE", "M", "FSYM", "TSYM", "F", "ID", "TS", "Q", "P", "TOTAL", "RTS"'

_KIND = """
    CASE WHEN event_type IN ('purchase', 'click') THEN 'trade'
         WHEN event_type = 'view' THEN 'ticker'
         WHEN event_type = 'error' THEN 'malformed'
         WHEN event_id % 50 = 0 THEN 'start'
         WHEN event_id % 50 = 25 THEN 'wrong_api_key'
         ELSE 'info' END
"""


def _window_start(period: int) -> str:
    return f'make_timestamp("TS" // {period} * {period} * 1000000)'


def _window_end(period: int) -> str:
    return f'make_timestamp(("TS" // {period} + 1) * {period} * 1000000)'


def _totals_sql(trades: str, period: int, where: str = "TRUE") -> str:
    return f"""
    SELECT CAST(date_trunc('day', {_window_end(period)}) AS TIMESTAMP) AS date,
           {_window_start(period)} AS window_start,
           {_window_end(period)} AS window_end,
           "M" AS market,
           CASE "F" WHEN '1' THEN 'SELL' ELSE 'BUY' END AS direction,
           "FSYM" AS fromcoin,
           'USD' AS tocurrency,
           CAST(sum(CAST("TOTAL" AS DECIMAL(18, 2))) AS DOUBLE) AS totalvol,
           CAST(sum(CAST("P" AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS avgprice,
           CAST(sum(CAST("Q" AS DECIMAL(18, 2))) AS DOUBLE) AS totalquantity,
           count(*) AS counttxns
    FROM ({trades})
    WHERE "F" IN ('1', '2') AND {where}
    GROUP BY ALL
    """


def oracle_sql() -> dict[str, str]:
    minute = _totals_sql(_EVENT_TRADES, 60)
    daily = _totals_sql(_LINE_TRADES, DAY)
    subscribed = "\"M\" IN ('Coinbase', 'Binance', 'Gemini')"
    on_time = (
        "NOT (event_id % 13 = 0 AND event_id < (SELECT (max(event_id) + 1) / 8 FROM events))"
    )
    sliced = f"""
        SELECT *, event_id * 4 // (SELECT max(event_id) + 1 FROM events) AS slice FROM ({_EVENT_TRADES})"""
    sided = """ "F" IN ('1', '2') """
    accounts = f"""
        SELECT CASE WHEN {on_time} THEN slice ELSE 3 END AS batch_id, count(*) AS input,
               CAST(0 AS BIGINT) AS rejected, count(*) FILTER (NOT {sided}) AS other_side,
               count(*) FILTER ({sided} AND {on_time}) AS taken,
               count(*) FILTER ({sided} AND NOT {on_time}) AS late,
               count(*) FILTER ({sided} AND NOT {on_time}) > 0 AS dropped
        FROM ({sliced}) GROUP BY 1"""
    accepted = _totals_sql(_EVENT_TRADES, HOUR, "event_id % 7 <> 0 AND event_id % 11 <> 0")
    training = {} if llm is None else dict(llm.oracle_sql())
    if llm is not None and corpus_pipeline.ORACLE_SQL is not None:
        training["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {
        **training,
        "side_filter": f"""SELECT "ID", "F" FROM ({_EVENT_TRADES}) WHERE "F" IN ('1', '2')""",
        "trade_normalize": f"""
            SELECT "ID" AS id, "FSYM" AS fromcoin, "TSYM" AS tocurrency, "M" AS market,
                   CASE "F" WHEN '1' THEN 'SELL' ELSE 'BUY' END AS direction,
                   make_timestamp("TS" * 1000000) AS timestamp,
                   "Q" AS quantity, "TOTAL" AS vol, "P" AS price
            FROM ({_EVENT_TRADES})""",
        "window_assign": f"""
            SELECT "ID" AS id, make_timestamp("TS" * 1000000) AS timestamp,
                   {_window_start(60)} AS window_start, {_window_end(60)} AS window_end
            FROM ({_EVENT_TRADES})""",
        "date_bucket": f"""
            SELECT "ID" AS id, {_window_end(HOUR)} AS window_end,
                   CAST(date_trunc('day', {_window_end(HOUR)}) AS TIMESTAMP) AS date
            FROM ({_EVENT_TRADES})""",
        "row_uuid": """
            SELECT event_id, CAST(36 AS BIGINT) AS uuid_length, '1' AS uuid_version,
                   TRUE AS uuid_variant_ok, epoch_us(ts) // 1000 AS uuid_millis
            FROM events""",
        "trade_window_agg": minute,
        "trade_window_agg_hourly": _totals_sql(_EVENT_TRADES, HOUR),
        "trade_window_agg_lineitem": daily,
        "trade_window_agg_stream": minute,
        "trade_window_agg_stream_lineitem": daily,
        "trade_window_agg_stateful": minute,
        "trade_window_agg_stateful_lineitem": daily,
        "narrow_partitions": daily,
        "bounded_run": f"SELECT *, CAST(3 AS BIGINT) AS state_partitions, TRUE AS stopped FROM ({minute})",
        "slices_native": minute,
        "slices_stateful": minute,
        "late_accounts_native": accounts,
        "late_accounts_stateful": accounts,
        # The watermark of the last slice comes from those before: five minutes less than their latest.
        "held_groups_native": f"""
            SELECT * FROM ({minute}) WHERE epoch_us(window_end) // 1000000 > (
                SELECT max("TS") - 300 FROM ({sliced}) WHERE slice < 3 AND "F" IN ('1', '2'))""",
        "held_groups_stateful": f"""
            SELECT * FROM ({minute}) SEMI JOIN (
                SELECT {_window_start(60)} AS window_start, "M" AS market,
                       CASE "F" WHEN '1' THEN 'SELL' ELSE 'BUY' END AS direction
                FROM ({sliced}) WHERE slice = 3 AND "F" IN ('1', '2'))
            USING (window_start, market, direction)""",
        "late_open_native": _totals_sql(_EVENT_TRADES, DECADE),
        "late_open_stateful": _totals_sql(_EVENT_TRADES, DECADE, on_time),
        "late_closed_native": _totals_sql(_EVENT_TRADES, 60, on_time),
        "late_closed_stateful": _totals_sql(_EVENT_TRADES, 60, on_time),
        "trade_acceptance": f"""
            SELECT *, unnest(['json', 'parquet']) AS format FROM ({accepted})""",
        "service_messages": """
            SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'start' ELSE 'wrong_api_key' END AS kind,
                   CASE WHEN event_id % 50 = 0 THEN 'welcome' ELSE 'refused' END AS text,
                   CASE WHEN event_id % 50 <> 0 THEN 'api_key' END AS parameter,
                   CASE WHEN event_id % 50 <> 0 THEN 'The key is not valid' END AS info
            FROM events WHERE event_type = 'signup' AND event_id % 50 IN (0, 25)""",
        "frame_classify": f"SELECT event_id, {_KIND} AS kind FROM events",
        "frame_kind_counts": f"SELECT {_KIND} AS kind, count(*) AS frames FROM events GROUP BY 1",
        "frame_quarantine": """
            SELECT event_id, 'malformed' AS kind, TRUE AS raw_start, FALSE AS raw_closed
            FROM events WHERE event_type = 'error'""",
        "frame_trades": f"""
            SELECT {_TRADE_COLUMNS} FROM ({_EVENT_TRADES})
            WHERE event_type IN ('purchase', 'click')""",
        "kafka_decode": f"""
            SELECT {_TRADE_COLUMNS} FROM ({_EVENT_TRADES}) WHERE event_type <> 'error'""",
        "kafka_encode_key": f"""
            SELECT 'WSTradeMsg-' || "F" || '-' || "M" AS key, count(*) AS records
            FROM ({_EVENT_TRADES}) GROUP BY 1""",
        "json_roundtrip": f"SELECT {_TRADE_COLUMNS} FROM ({_LINE_TRADES})",
        "subscription_filter": f"""
            SELECT "ID", "M", "FSYM", "TSYM" FROM ({_EVENT_TRADES}) WHERE {subscribed}""",
        "subscription_added": f"""
            WITH middle AS (
                SELECT (epoch_us(min(ts)) // 1000000 + epoch_us(max(ts)) // 1000000) // 2 AS mid FROM events)
            SELECT "ID", "M", "FSYM", "TSYM" FROM ({_EVENT_TRADES}), middle
            WHERE "M" = 'Coinbase' OR "M" = 'Binance' AND "TS" >= mid OR "M" = 'Gemini' AND "TS" < mid""",
        "sink_latest": minute,
        "serve_by_date": f"""
            SELECT * FROM ({minute}) WHERE date = TIMESTAMP '{SERVED_DAY} 00:00:00'""",
        "serve_windows": f"""
            SELECT * FROM ({minute}) WHERE window_end > TIMESTAMP '{SERVED_WINDOWS[0]}'
            AND window_end <= TIMESTAMP '{SERVED_WINDOWS[1]}'""",
        "trade_file_stream": daily,
        "trade_push_stream": minute,
        "topic_to_table": minute,
        "feed_to_topic": _totals_sql(_EVENT_TRADES, HOUR, subscribed),
    }
