"""Subscriptions that begin and end while trades come in."""

import datetime

import pytest
from helpers import trade, trades_frame, write_batches

from tapeline.operators.subscriptions import subscribed_at
from tapeline.schemas import TRADE
from tapeline.sources.files import read_trades
from tapeline.streaming.runs import start

PERIOD = "channel string, valid_from timestamp, valid_to timestamp"


def clock(text, day=8):
    return datetime.datetime.fromisoformat(f"2021-01-{day:02d}T{text}+00:00")


def periods(spark, rows):
    return spark.createDataFrame(rows, PERIOD)


def ids(frame):
    return sorted(int(r.ID) for r in frame.collect())


def test_periods_as_a_batch(spark):
    trades = trades_frame(spark, [
        trade("10:00:00", ID="1"), trade("09:59:59", ID="2"), trade("10:29:59", ID="3"),
        trade("10:30:00", ID="4"), trade("11:00:00", ID="5"), trade("11:00:00", ID="6", M="Kraken"),
        trade("11:00:00", ID="7", day="2021-01-09"), trade("11:00:00", ID="8", TSYM="EUR"),
    ])
    rows = [
        ("0~Coinbase~BTC~USD", clock("10:00:00"), clock("10:30:00")),
        ("0~Coinbase~BTC~USD", clock("10:10:00"), clock("10:30:00")),
        ("0~Coinbase~BTC~USD", clock("10:50:00"), None),
        ("2~Kraken~BTC~USD", clock("10:00:00"), None), ("0~Kraken~BTC", clock("10:00:00"), None),
        (None, clock("10:00:00"), None), ("0~Coinbase~BTC~EUR", None, None),
    ]
    assert ids(subscribed_at(trades, periods(spark, rows))) == [1, 3, 5]
    # A period without an end is as long as it may be.
    assert ids(subscribed_at(trades, periods(spark, rows), longest="2 days")) == [1, 3, 5, 7]
    # And one with an end is no longer.
    assert ids(subscribed_at(trades, periods(spark, rows), longest="10 minutes")) == [1]
    assert subscribed_at(trades, periods(spark, rows)).columns == trades.columns


def test_a_subscription_that_comes_while_trades_run(spark, tmp_path):
    """A trade that came before its subscription is kept if it is of its time; state is cleaned on both sides."""
    trades, feed, out = tmp_path / "in", str(tmp_path / "subs"), str(tmp_path / "out")
    first = [("0~Coinbase~BTC~USD", clock("10:00:00"), None)]
    periods(spark, first).coalesce(1).write.parquet(feed)

    def step(number, rows, more=()):
        write_batches(trades, [rows], first=number)
        if more:
            periods(spark, list(more)).coalesce(1).write.mode("append").parquet(feed)
        kept = subscribed_at(
            read_trades(spark, str(trades)),
            spark.readStream.schema(PERIOD).parquet(feed),
            longest="1 hour",
        )
        writer = kept.writeStream.format("parquet").option("path", out)
        query = start(spark, writer, str(tmp_path / "state"), once=True, shuffle_partitions=2)
        query.awaitTermination()
        (state,) = query.recentProgress[-1].stateOperators
        return ids(spark.read.schema("ID string").parquet(out)), state.numRowsTotal

    got, _ = step(0, [trade("10:01:00", ID="1"), trade("10:02:00", ID="2", M="Kraken"),
                      trade("10:00:30", ID="3", M="Kraken")])
    assert got == [1]
    got, held = step(1, [trade("10:03:00", ID="4", M="Kraken")],
                     [("0~Kraken~BTC~USD", clock("10:01:00"), None)])
    assert got == [1, 2, 4]
    assert held >= 3
    # Later trades and subscriptions move both watermarks: what is past them leaves the state.
    later = [("0~Coinbase~BTC~USD", clock("14:00:00"), None), ("0~Gemini~BTC~USD", clock("14:00:00"), None)]
    got, _ = step(2, [trade("14:00:10", ID="5"), trade("14:00:11", ID="6", M="Kraken")], later)
    assert got == [1, 2, 4, 5]
    _, held = step(3, [trade("14:01:00", ID="7", M="Gemini")])
    assert held <= 6
    got, _ = step(4, [trade("14:02:00", ID="8"), trade("10:02:30", ID="9", M="Kraken")])
    assert got == [1, 2, 4, 5, 7, 8]


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_renewed_periods_keep_a_trade_once(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    rows = [("0~Coinbase~BTC~USD", clock("10:00:00"), None)] * 3
    trades = trades_frame(spark, [trade(ID="1"), trade(ID="1")])
    assert ids(subscribed_at(trades, periods(spark, rows))) == [1, 1]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_channel_waits_in_several_tasks(spark, tmp_path):
    """Its trades are spread over the state, and a period that comes later finds all of them, once."""
    trades, feed, out, state = (str(tmp_path / x) for x in ("in", "subs", "out", "state"))
    some = [trade(f"10:00:{i % 60:02d}", ID=str(i), M="Kraken") for i in range(200)]
    some += [trade("10:00:00", ID=str(200 + i), TS=None, M="Kraken") for i in range(2)]
    some += [trade("10:00:00", ID=None, M="Kraken"), trade("09:59:59", ID="300", M="Kraken")]

    def step(number, rows, more):
        write_batches(tmp_path / "in", [rows], first=number)
        periods(spark, more).coalesce(1).write.mode("append").parquet(feed)
        kept = subscribed_at(
            spark.readStream.schema(TRADE).json(trades),
            spark.readStream.schema(PERIOD).parquet(feed),
            longest="1 hour",
            buckets=16,
        )
        writer = kept.writeStream.format("parquet").option("path", out)
        start(spark, writer, state, once=True, shuffle_partitions=4).awaitTermination()
        return sorted(r.ID or "" for r in spark.read.schema("ID string").parquet(out).collect())

    assert step(0, some, [("0~Gemini~BTC~USD", clock("10:00:00"), None)]) == []
    left = spark.read.format("statestore").option("joinSide", "left").load(state)
    held = {r.partition_id: r["count"] for r in left.groupBy("partition_id").count().collect()}
    assert sum(held.values()) >= 201
    # By channel alone, one task has them all.
    assert len(held) > 1 and max(held.values()) < 150
    kraken = [("0~Kraken~BTC~USD", clock("10:00:00"), None)] * 2
    later = [trade("10:00:30", ID="400", M="Kraken"), trade("10:00:31", ID="401", M="Binance")]
    assert step(1, later, kraken) == sorted(["", *map(str, range(200)), "400"])
