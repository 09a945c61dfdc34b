"""The stream that rows are pushed to."""

import json
import time

import pytest
from helpers import trade, trades_frame
from pyspark.sql import functions as F
from test_streams import BATCHES, NATIVE, STATEFUL, as_rows

from tapeline.operators.served import as_totals, latest_rows
from tapeline.operators.totals import window_totals
from tapeline.schemas import TRADE
from tapeline.sources.pushed import push_rows, pushed_trades, read_pushed
from tapeline.streaming.runs import STATE_SETTINGS, start
from tapeline.streaming.sinks import append_to_log, read_log, with_row_ids
from tapeline.streaming.stateful import stateful_totals


def push(spark, folder, rows, parts=1):
    push_rows(trades_frame(spark, rows).repartition(parts), str(folder))


def ids(frame):
    return sorted(int(r.ID) for r in frame.collect())


@pytest.mark.parametrize(("make", "expected"), [(window_totals, NATIVE), (stateful_totals, STATEFUL)])
def test_golden_batches_pushed_into_a_running_query(spark, tmp_path, make, expected):
    seen = {}

    def keep(batch, batch_id):
        rows = batch.collect()
        seen[batch_id] = sorted((f"{r.window_start:%H:%M}", round(r.avgprice, 2), r.counttxns) for r in rows)

    push(spark, tmp_path / "feed", [trade("09:00:00", F="4")])
    writer = make(pushed_trades(spark, str(tmp_path / "feed"))).writeStream.outputMode("update")
    # As in the golden table, no batches without trades: one would forget what the last one changed.
    quiet = {**STATE_SETTINGS, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    query = start(spark, writer.foreachBatch(keep), str(tmp_path / "state"), interval="0 seconds",
                  state_settings=quiet)
    try:
        for batch in as_rows(BATCHES):
            push(spark, tmp_path / "feed", batch)
            query.processAllAvailable()
    finally:
        query.stop()
    assert [seen[n] for n in sorted(seen) if seen[n]] == expected


def totals_into(spark, tmp_path, write):
    totals = with_row_ids(window_totals(pushed_trades(spark, str(tmp_path / "feed"))))
    writer = totals.writeStream.outputMode("update").foreachBatch(write)
    return start(spark, writer, str(tmp_path / "state"), once=True)


def test_a_batch_that_failed_is_run_again_with_the_same_rows(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = [trade(f"10:00:{n:02d}", float(n), ID=str(n)) for n in range(60)]
    push(spark, tmp_path / "feed", rows[:20], parts=3)

    def fail(batch, batch_id):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        totals_into(spark, tmp_path, fail).awaitTermination()
    # Rows that come between belong to a later batch.
    push(spark, tmp_path / "feed", rows[20:], parts=4)
    # A run with `once` is one micro-batch: first the one that failed.
    for _ in range(2):
        totals_into(spark, tmp_path, append_to_log(log)).awaitTermination()
    counts = {r.batch_id: r.counttxns for r in read_log(spark, log).collect()}
    assert counts == {0: 20, 1: 60}
    (total,) = as_totals(latest_rows(read_log(spark, log))).collect()
    assert (total.counttxns, total.avgprice) == (60, 29.5)


def test_offsets_parts_and_dropped_rows(spark, tmp_path):
    feed = tmp_path / "feed"
    for first in (0, 10, 20):
        push(spark, feed, [trade(ID=str(n)) for n in range(first, first + 10)], parts=3)
    assert ids(read_pushed(spark, str(feed), TRADE, stream=False)) == list(range(30))
    assert sorted(p.name for p in (feed / "log").glob("[0-9]*")) == [f"{n:020d}.json" for n in (0, 10, 20)]
    got = {}

    def read(state, **options):
        stream = read_pushed(spark, str(feed), TRADE, **options)
        writer = stream.writeStream.foreachBatch(lambda b, i: got.setdefault((state, i), ids(b)))
        query = start(spark, writer, str(tmp_path / state), interval="0 seconds")
        query.processAllAvailable()
        return query

    query = read("all", dropCommitted="true")
    push(spark, feed, [trade(ID="30")])
    query.processAllAvailable()
    push(spark, feed, [trade(ID="31")])
    query.processAllAvailable()
    query.stop()
    assert [got[key] for key in sorted(got)] == [list(range(30)), [30], [31]]
    offsets = (tmp_path / "all" / "offsets" / "2").read_text().splitlines()
    assert json.loads(offsets[-1]) == {"row": 32}
    # What all batches but the last are done with is gone, files and entries.
    first = min(int(p.name[:-5]) for p in (feed / "log").glob("[0-9]*"))
    assert first >= 30
    assert len(list((feed / "rows").iterdir())) <= 2
    got.clear()
    late = read("late", startingOffsets="latest")
    assert not any(got.values())
    push(spark, feed, [trade(ID="32"), trade(ID="33")])
    late.processAllAvailable()
    late.stop()
    assert [rows for rows in got.values() if rows] == [[32, 33]]


def test_an_append_is_whole_or_not_there(spark, tmp_path):
    feed = str(tmp_path / "feed")
    push(spark, tmp_path / "feed", [trade(ID="1")])
    broken = trades_frame(spark, [trade(ID=str(n)) for n in range(2, 10)]).repartition(4)
    fails = broken.withColumn("RTS", F.when(F.col("ID") == "7", F.raise_error("broken row")).otherwise(F.col("RTS")))
    with pytest.raises(Exception, match="broken row"):
        push_rows(fails, feed)
    assert ids(read_pushed(spark, feed, TRADE, stream=False)) == [1]
    push(spark, tmp_path / "feed", [])
    push(spark, tmp_path / "feed", [trade(ID="10")])
    assert ids(read_pushed(spark, feed, TRADE, stream=False)) == [1, 10]
    with pytest.raises(Exception, match="only appended"):
        broken.write.format("tapeline_pushed").mode("overwrite").save(feed)


def test_unusable_rows_are_counted(spark, tmp_path):
    push(spark, tmp_path / "feed", [trade(), trade(Q=None), trade(TS=10**17)])
    writer = pushed_trades(spark, str(tmp_path / "feed")).writeStream.format("noop")
    query = start(spark, writer, str(tmp_path / "state"), once=True)
    query.awaitTermination()
    time.sleep(0.1)
    counts = [p.observedMetrics["decode"] for p in query.recentProgress if p.numInputRows]
    assert [(c.accepted, c.rejected) for c in counts] == [(1, 2)]
