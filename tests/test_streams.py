"""Late rows, state, update output, restart and replay, against hand-made micro-batches."""

import json
import uuid

import pytest
from helpers import seconds, text_frame, trade, trades_frame, write_batches
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tapeline.operators.records import encode_records
from tapeline.operators.served import (
    MARKET_KEY,
    as_totals,
    latest_rows,
    rows_of_date,
)
from tapeline.operators.totals import window_totals
from tapeline.plans.jobs import (
    feed_to_topic,
    live_view,
    malformed_frames,
    malformed_records,
    service_frames,
    set_aside,
    topic_to_table,
)
from tapeline.schemas import TOTALS
from tapeline.sources.files import read_lines, read_trades, rejected_trades
from tapeline.sources.kafka import read_topic, topic_options
from tapeline.streaming import manifests
from tapeline.streaming.runs import run_for, session_settings, start, work_folder
from tapeline.streaming.sinks import (
    append_to,
    append_to_log,
    drop_folded,
    fold_log,
    keep_table,
    read_log,
    read_served,
    read_table,
    topic_writer,
    with_row_ids,
)
from tapeline.streaming.stateful import stateful_totals

# Micro-batches of the golden table: (time, price). The watermark is the latest time of the
# batches before, less 5 minutes; late rows are judged by the watermark of the batch before, so
# the third batch is needed for the fourth to hold a late row.
BATCHES = [
    [("10:00:10", 100.0)],
    [("10:05:30", 110.0)],
    [("10:05:31", 111.0)],
    [("10:00:20", 1.0), ("10:00:50", 200.0)],
    [("10:20:00", 5.0)],
]
NATIVE = [
    [("10:00", 100.0, 1)],
    [("10:05", 110.0, 1)],
    [("10:05", 110.5, 2)],
    [("10:00", 100.33, 3)],
    [("10:20", 5.0, 1)],
]
STATEFUL = [
    [("10:00", 100.0, 1)],
    [("10:05", 110.0, 1)],
    [("10:05", 110.5, 2)],
    [("10:00", 200.0, 1)],
    [("10:20", 5.0, 1)],
]


def as_rows(batches):
    return [[trade(clock, price) for clock, price in batch] for batch in batches]


def emitted(spark, tmp_path, make, batches, checkpoint="state"):
    """Rows emitted per micro-batch, one file each."""
    write_batches(tmp_path / "in", batches)
    seen = {}

    def keep(batch, batch_id):
        rows = [
            (f"{row.window_start:%H:%M}", round(row.avgprice, 2), row.counttxns)
            for row in batch.collect()
        ]
        seen.setdefault(batch_id, sorted(rows))

    trades = read_trades(spark, str(tmp_path / "in"), maxFilesPerTrigger=1)
    writer = make(trades).writeStream.outputMode("update").foreachBatch(keep)
    start(spark, writer, str(tmp_path / checkpoint), once=True).awaitTermination()
    return [seen[number] for number in sorted(seen) if seen[number]]


@pytest.mark.parametrize(
    ("make", "expected"), [(window_totals, NATIVE), (stateful_totals, STATEFUL)]
)
def test_golden_batches(spark, tmp_path, make, expected):
    assert emitted(spark, tmp_path, make, as_rows(BATCHES)) == expected


@pytest.mark.parametrize("make", [window_totals, stateful_totals])
def test_rows_of_closed_windows_are_dropped(spark, tmp_path, make):
    batches = as_rows([[("10:00:10", 1.0)], [("10:30:00", 2.0)], [("10:31:00", 3.0)],
                       [("10:00:20", 4.0), ("10:31:01", 3.0)]])
    assert emitted(spark, tmp_path, make, batches)[-1] == [("10:31", 3.0, 2)]


@pytest.mark.parametrize("make", [window_totals, stateful_totals])
def test_a_stream_in_fewer_partitions(spark, tmp_path, make):
    def narrow(trades):
        return make(trades, 300, max_partitions=2)

    ((group,),) = emitted(spark, tmp_path, narrow, [on_time(1) * 40])
    assert group[2] == 40


@pytest.mark.parametrize("make", [window_totals, stateful_totals])
def test_only_changed_groups_are_emitted(spark, tmp_path, make):
    batches = [
        [trade("10:00:01"), trade("10:00:02", M="Kraken")],
        [trade("10:00:03", 102.0)],
    ]
    assert emitted(spark, tmp_path, make, batches)[1] == [("10:00", 101.0, 2)]


def test_stateful_combines_before_the_shuffle(spark, tmp_path):
    """Many trades in one group: every one counts, over several Arrow batches."""
    rows = [trade(f"10:00:{n % 60:02d}", float(n % 7), ID=str(n)) for n in range(25_000)]
    (batch,) = emitted(spark, tmp_path, stateful_totals, [rows])
    mean = sum(n % 7 for n in range(25_000)) / 25_000
    assert batch == [("10:00", round(mean, 2), 25_000)]


def logged(spark, tmp_path, trades, make=window_totals, state="state", log="log", **run):
    writer = (
        with_row_ids(make(trades))
        .writeStream.outputMode("update")
        .foreachBatch(append_to_log(str(tmp_path / log)))
    )
    start(spark, writer, str(tmp_path / state), once=True, **run).awaitTermination()


def rows_of(totals):
    return sorted(
        tuple(round(v, 6) if isinstance(v, float) else v for v in row)
        for row in totals.collect()
    )


def on_time(count=300):
    return [
        trade(f"10:{n % 4:02d}:{n % 60:02d}", float(n % 11), ID=str(n), F=str(1 + n % 3),
              M=["Kraken", "Gemini"][n % 2])
        for n in range(count)
    ]


@pytest.mark.parametrize("make", [window_totals, stateful_totals])
def test_stream_equals_batch(spark, tmp_path, make):
    rows = on_time()
    write_batches(tmp_path / "in", [rows])
    logged(spark, tmp_path, read_trades(spark, str(tmp_path / "in")), make)
    latest = as_totals(latest_rows(read_log(spark, str(tmp_path / "log"))))
    assert rows_of(latest) == rows_of(window_totals(trades_frame(spark, rows)))


def test_restart_from_checkpoint_equals_one_run(spark, tmp_path):
    rows = on_time()
    for number, part in enumerate((rows[:100], rows[100:])):
        write_batches(tmp_path / "in", [part], first=number)
        logged(spark, tmp_path, read_trades(spark, str(tmp_path / "in")))
    log = read_log(spark, str(tmp_path / "log"))
    assert log.select("batch_id").distinct().count() >= 2
    assert rows_of(as_totals(latest_rows(log))) == rows_of(
        window_totals(trades_frame(spark, rows))
    )


def test_a_failed_batch_is_run_again_with_the_same_ids(spark, tmp_path):
    write_batches(tmp_path / "in", [on_time()])
    log = str(tmp_path / "log")
    first = []

    def fail_after_writing(batch, batch_id):
        append_to_log(log)(batch, batch_id)
        if not first:
            first.extend(row.uuid for row in read_log(spark, log).collect())
            raise RuntimeError("lost after the write")

    for attempt in range(2):
        trades = read_trades(spark, str(tmp_path / "in"))
        writer = with_row_ids(window_totals(trades)).writeStream.outputMode("update")
        query = start(spark, writer.foreachBatch(fail_after_writing), str(tmp_path / "state"),
                      once=True)
        if attempt == 0:
            with pytest.raises(Exception, match="lost after the write"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    again = [row.uuid for row in read_log(spark, log).collect()]
    assert sorted(again) == sorted(first)
    assert len(set(again)) == len(again) > 0
    assert {uuid.UUID(value).version for value in again} == {1}


def test_new_checkpoint_on_an_old_log(spark, tmp_path):
    """Batch ids start again at 0; the rows of the later run are the latest."""
    write_batches(tmp_path / "a", [[trade(price=1.0)], [trade(price=3.0)]])
    write_batches(tmp_path / "b", [[trade(price=9.0)]])
    for name in ("a", "b"):
        source = read_trades(spark, str(tmp_path / name), maxFilesPerTrigger=1)
        logged(spark, tmp_path, source, state=f"state-{name}")
    (row,) = latest_rows(read_log(spark, str(tmp_path / "log"))).collect()
    assert (row.avgprice, row.counttxns) == (9.0, 1)


def test_dates_follow_the_session_time_zone(spark, tmp_path):
    """In a zone one hour ahead, the day that ends at 23:00 UTC gives way to the next."""
    with session_settings(spark, {"spark.sql.session.timeZone": "Etc/GMT-1"}):
        rows = [trade("22:58:30"), trade("22:59:30")]
        totals = window_totals(trades_frame(spark, rows)).orderBy("window_end")
        dates = [row.s for row in totals.select(F.unix_seconds("date").alias("s")).collect()]
        assert dates == [seconds("23:00:00", "2021-01-07"), seconds("23:00:00")]
        log = one_log(spark, tmp_path, [rows])
        served = latest_rows(read_log(spark, log))
        assert [str(row.date) for row in served.orderBy("date").select("date").collect()] == [
            "2021-01-08", "2021-01-09",
        ]
        assert rows_of(as_totals(served)) == rows_of(totals)


def one_log(spark, tmp_path, batches, by_date=False):
    log = str(tmp_path / "log")
    for batch_id, rows in enumerate(batches):
        totals = window_totals(trades_frame(spark, rows))
        stamped = totals.withColumn("batch_ms", F.lit(1_000 + batch_id).cast("bigint"))
        append_to_log(log, by_date)(stamped.withColumn("uuid", F.lit("u")), batch_id)
    return log


def test_keys_of_the_served_table(spark, tmp_path):
    log = one_log(spark, tmp_path, [[trade(FSYM="BTC"), trade(FSYM="ETH", price=2.0)]])
    assert latest_rows(read_log(spark, log)).count() == 2
    (row,) = latest_rows(read_log(spark, log), MARKET_KEY).collect()
    assert (row.fromcoin, row.avgprice) == ("ETH", 2.0)


@pytest.mark.parametrize("by_date", [False, True])
def test_a_batch_written_twice_is_there_once(spark, tmp_path, by_date):
    log = str(tmp_path / "log")
    rows = [trade(), trade(day="2021-01-09"), trade("10:05:00", 3.0)]
    for _ in range(2):
        assert one_log(spark, tmp_path, [rows[:2], rows], by_date) == log
        assert read_log(spark, log).count() == 5
        assert rows_of(as_totals(latest_rows(read_log(spark, log)))) == rows_of(
            window_totals(trades_frame(spark, rows))
        )
    assert (tmp_path / "log" / "date=2021-01-09").exists() == by_date
    assert rows_of_date(latest_rows(read_log(spark, log)), "2021-01-09").count() == 1


def test_a_feed_without_buys_and_sells(spark, tmp_path):
    write_batches(tmp_path / "in", [[trade(F="4")]])
    logged(spark, tmp_path, read_trades(spark, str(tmp_path / "in")))
    assert latest_rows(read_log(spark, str(tmp_path / "log"))).count() == 0


@pytest.mark.parametrize("parts", [2, 5])
def test_on_time_trades_in_any_number_of_batches(spark, tmp_path, parts):
    rows = sorted(on_time(200), key=lambda row: row["TS"])
    size = -(-len(rows) // parts)
    write_batches(tmp_path / "in", [rows[n : n + size] for n in range(0, len(rows), size)])
    logged(spark, tmp_path, read_trades(spark, str(tmp_path / "in"), maxFilesPerTrigger=1))
    log = read_log(spark, str(tmp_path / "log"))
    assert log.select("batch_id").distinct().count() == parts
    assert rows_of(as_totals(latest_rows(log))) == rows_of(
        window_totals(trades_frame(spark, rows))
    )


def test_fold_and_serve(spark, tmp_path):
    days = ["2021-01-08", "2021-01-09", "2021-01-10"]
    rows = [trade(f"1{n % 3}:00:00", day=day, M=market, F=flag)
            for day in days for n in range(3) for market in ("Kraken", "Gemini") for flag in "12"]
    log = one_log(spark, tmp_path, [rows[:10], rows])
    table = str(tmp_path / "table")
    fold_log(spark, log, table, "2021-01-08", "2021-01-09")
    fold_log(spark, log, table, "2021-01-09", "2021-01-09")
    served = read_table(spark, table)
    assert {str(row.date) for row in served.select("date").collect()} == set(days[:2])
    day = rows_of_date(served, "2021-01-09").collect()
    order = [(-row.window_end.timestamp(), row.direction, row.market) for row in day]
    assert len(day) == 12
    assert order == sorted(order)
    assert {row.counttxns for row in day} == {1}
    assert as_totals(served, with_uuid=True).columns[-1] == "uuid"


def test_append_to_a_connector(spark, tmp_path):
    records = records_folder(spark, tmp_path / "topic", on_time(10))
    write = append_to("parquet", path=str(tmp_path / "out"))
    topic_to_table(records, write, str(tmp_path / "state"), once=True).awaitTermination()
    table = spark.read.parquet(str(tmp_path / "out"))
    assert table.columns == [*TOTALS.fieldNames(), "uuid"]
    assert table.count() > 0


def test_live_view_on_the_console(spark, tmp_path):
    write_batches(tmp_path / "in", [on_time(10)])
    query = live_view(read_trades(spark, str(tmp_path / "in")), str(tmp_path / "state"), once=True)
    query.awaitTermination()
    assert "Console" in query.recentProgress[0].sink.description
    assert query.recentProgress[0].numInputRows > 0
    assert query.recentProgress[0].stateOperators[0].numRowsTotal > 0


def test_bounded_run_and_interval(spark, tmp_path):
    write_batches(tmp_path / "in", [on_time(10)])
    query = live_view(
        read_trades(spark, str(tmp_path / "in")), str(tmp_path / "state"), interval="1 second"
    )
    assert run_for(query, 3) is False
    assert not query.isActive


def records_folder(spark, folder, rows, bad=()):
    values = [json.dumps(row) for row in rows] + list(bad)
    records = spark.createDataFrame([(b"k", v.encode()) for v in values], "key binary, value binary")
    records.write.parquet(str(folder))
    return spark.readStream.schema(records.schema).parquet(str(folder))


@pytest.mark.parametrize("totals", [window_totals, stateful_totals])
def test_topic_to_table(spark, tmp_path, totals):
    rows = on_time()
    records = records_folder(spark, tmp_path / "topic", rows, bad=['{"TYPE":', "x"])
    log = str(tmp_path / "log")
    query = topic_to_table(records, append_to_log(log), str(tmp_path / "state"), totals=totals,
                           once=True, shuffle_partitions=3)
    query.awaitTermination()
    assert rows_of(as_totals(latest_rows(read_log(spark, log)))) == rows_of(
        window_totals(trades_frame(spark, rows))
    )
    counts = [p.observedMetrics["decode"] for p in query.recentProgress if p.numInputRows]
    assert [(c.accepted, c.rejected) for c in counts] == [(300, 2)]
    assert len(list((tmp_path / "state" / "state" / "0").glob("[0-9]*"))) == 3
    aside = set_aside(malformed_records(records), str(tmp_path / "bad"), str(tmp_path / "s2"),
                      once=True)
    aside.awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "bad"))
    assert sorted(bytes(row.value) for row in kept.collect()) == [b"x", b'{"TYPE":']


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_feed_to_topic_of_some_channels(spark, tmp_path, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    write_batches(tmp_path / "in", [on_time(20)])
    out = str(tmp_path / "out")
    feed_to_topic(
        read_lines(spark, str(tmp_path / "in")),
        lambda records: records.writeStream.format("parquet").option("path", out),
        str(tmp_path / "state"),
        channels=["0~Kraken~BTC~USD"],
        once=True,
    ).awaitTermination()
    records = spark.read.parquet(out).collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(int(json.loads(row.value)["ID"]) for row in records) == list(range(0, 20, 2))


def test_feed_to_topic(spark, tmp_path):
    frames = [json.dumps(row) for row in on_time(9)] + ['{"TYPE":"999"', "{}"]
    frames.append(json.dumps({"TYPE": "999", "MESSAGE": "heartbeat", "TIMEMS": 1}))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "frames.txt").write_text("\n".join(frames) + "\n")
    source = read_lines(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    query = feed_to_topic(
        source,
        lambda records: records.writeStream.format("parquet").option("path", out),
        str(tmp_path / "state"),
        once=True,
    )
    query.awaitTermination()
    records = spark.read.parquet(out).collect()
    assert {row.key.split("-")[0] for row in records} == {"WSTradeMsg"}
    assert sorted(json.loads(row.value)["ID"] for row in records) == [str(n) for n in range(9)]
    kinds = query.recentProgress[0].observedMetrics["frame_kinds"]
    assert (kinds.trade, kinds.info, kinds.malformed) == (9, 1, 2)
    aside = set_aside(malformed_frames(source), str(tmp_path / "bad"), str(tmp_path / "s2"),
                      once=True)
    aside.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2


def test_trades_from_files_as_a_batch(spark, tmp_path):
    write_batches(tmp_path / "in", [on_time(10)])
    trades = read_trades(spark, str(tmp_path / "in"), stream=False)
    assert trades.count() == 10
    trades.write.parquet(str(tmp_path / "p"))
    read = read_trades(spark, str(tmp_path / "p"), file_format="parquet", stream=False)
    assert read.schema == trades.schema
    assert sorted(read.collect()) == sorted(trades.collect())


def test_topic_options():
    assert topic_options("host:9092", "trades", minPartitions=64) == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "trades",
        "startingOffsets": "latest",
        "minPartitions": "64",
    }


@pytest.mark.parametrize("side", ["source", "sink"])
def test_topic_needs_the_connector(spark, tmp_path, side):
    write_batches(tmp_path / "in", [on_time(3)])
    with pytest.raises(AnalysisException, match="kafka"):
        if side == "source":
            read_topic(spark, "host:9092", "trades")
        else:
            trades = read_trades(spark, str(tmp_path / "in"))
            writer = topic_writer(encode_records(trades), "host:9092", "trades")
            start(spark, writer, str(tmp_path / "state"), once=True)


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session_settings(spark, {"spark.sql.shuffle.partitions": "3", "tapeline.x": "1"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("tapeline.x", None) is None


def test_work_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    folder = work_folder(spark, "x")
    assert folder != work_folder(spark, "x")
    assert folder.startswith(shared)


def test_work_folder_without_a_setting_is_in_the_warehouse(spark):
    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(name, default=None):
                return "/w" if name == "spark.sql.warehouse.dir" else default

    assert work_folder(Session, "x").startswith("/w/_work/tapeline/x-")


def stamped_log(spark, path, batch_id, rows):
    totals = window_totals(trades_frame(spark, rows)).withColumn("uuid", F.lit("u"))
    stamped = totals.withColumn("batch_ms", F.lit(1_000 + batch_id).cast("bigint"))
    append_to_log(path)(stamped, batch_id)


def test_folds_lose_no_row_when_folded_batches_are_dropped(spark, tmp_path):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    stamped_log(spark, log, 0, [trade(), trade(M="Kraken"), trade(day="2021-01-09")])
    drop_folded(spark, log, fold_log(spark, log, table))
    assert not list((tmp_path / "log").glob("batch_ms=*"))
    # A late trade of one key, and a key that is new.
    stamped_log(spark, log, 1, [trade(), trade(price=7.0), trade(M="Gemini")])
    fold_log(spark, log, table)
    served = {(r.market, str(r.date)): r.counttxns for r in read_table(spark, table).collect()}
    assert served == {
        ("Coinbase", "2021-01-08"): 2, ("Kraken", "2021-01-08"): 1,
        ("Gemini", "2021-01-08"): 1, ("Coinbase", "2021-01-09"): 1,
    }
    # Folding once more changes nothing, and only one generation of each date is left.
    fold_log(spark, log, table, retain_seconds=0)
    assert read_table(spark, table).count() == 4
    dates = [p.name for p in (tmp_path / "table").glob("generation=*/date=*")]
    assert sorted(dates) == sorted(set(dates))


def test_a_fold_that_stops_before_it_cleans_up(spark, tmp_path, monkeypatch):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    stamped_log(spark, log, 0, [trade(), trade(M="Kraken")])
    fold_log(spark, log, table)
    stamped_log(spark, log, 1, [trade(), trade()])

    def stop(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(manifests, "remove", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        fold_log(spark, log, table, retain_seconds=0)
    monkeypatch.undo()
    for _ in range(2):
        served = {r.market: r.counttxns for r in read_served(spark, log, table).collect()}
        assert served == {"Coinbase": 2, "Kraken": 1}
        fold_log(spark, log, table)


@pytest.mark.parametrize("every", [1, 2, 40])
def test_a_table_kept_current(spark, tmp_path, every):
    rows = sorted(on_time(120), key=lambda row: row["TS"])
    write_batches(tmp_path / "in", [rows[n : n + 40] for n in range(0, 120, 40)])
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    assert read_served(spark, log, table).count() == 0
    totals = with_row_ids(window_totals(read_trades(spark, str(tmp_path / "in"), maxFilesPerTrigger=1)))
    writer = totals.writeStream.outputMode("update").foreachBatch(keep_table(log, table, every))
    start(spark, writer, str(tmp_path / "state"), once=True).awaitTermination()
    assert rows_of(as_totals(read_served(spark, log, table))) == rows_of(
        window_totals(trades_frame(spark, rows))
    )


@pytest.mark.parametrize("file_format", ["json", "parquet", "orc"])
def test_one_rule_for_stored_trades(spark, tmp_path, file_format):
    rows = [trade(ID="good"), trade(ID="q", Q=None), trade(ID="m", M=None),
            trade(ID="late", TS=10**17), trade(ID="nan", P=float("nan"))]
    path = str(tmp_path / "t")
    stored = trades_frame(spark, rows)
    if file_format == "json":
        stored.selectExpr("to_json(struct(*)) AS value").write.text(path)
    else:
        stored.write.format(file_format).save(path)
    read = read_trades(spark, path, file_format=file_format, stream=False)
    assert [row.ID for row in read.collect()] == ["good"]
    out = str(tmp_path / "out")
    streamed = read_trades(spark, path, file_format=file_format)
    writer = streamed.writeStream.format("parquet").option("path", out)
    query = start(spark, writer, str(tmp_path / "state"), once=True)
    query.awaitTermination()
    counts = [p.observedMetrics["decode"] for p in query.recentProgress if p.numInputRows]
    assert (sum(c.accepted for c in counts), sum(c.rejected for c in counts)) == (1, 4)
    if file_format != "json":
        left = rejected_trades(spark, path, file_format=file_format, stream=False)
        assert {row.ID for row in left.collect()} == {"q", "m", "late", "nan"}


def test_service_messages(spark):
    texts = [
        json.dumps({"TYPE": "401", "MESSAGE": "refused", "PARAMETER": "api_key", "INFO": "no"}),
        json.dumps(trade()), "{}",
    ]
    (row,) = service_frames(text_frame(spark, texts)).collect()
    assert (row.kind, row.text, row.parameter, row.info) == ("wrong_api_key", "refused", "api_key", "no")
