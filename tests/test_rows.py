"""Row operators and totals on hand-made trades."""

from datetime import datetime

import pytest
from helpers import trade, trades_frame
from pyspark.sql import functions as F

from tapeline.functions.trades import side_label
from tapeline.operators.normalize import assign_window, keep_sides, normalize_trades
from tapeline.operators.subscriptions import DEFAULT_CHANNELS, subscribed_trades
from tapeline.operators.totals import window_totals
from tapeline.schemas import NORMAL_TRADE, TOTALS


def at(clock, day="2021-01-08"):
    return datetime.fromisoformat(f"{day}T{clock}")


def types_of(schema):
    return [(field.name, field.dataType) for field in schema]


def test_only_buys_and_sells_are_kept(spark):
    rows = [trade(ID=str(i), F=flag) for i, flag in enumerate(["1", "2", "4", "", "11", None])]
    kept = normalize_trades(keep_sides(trades_frame(spark, rows))).collect()
    assert {(row.id, row.direction) for row in kept} == {("0", "SELL"), ("1", "BUY")}


def test_any_flag_but_sell_is_labelled_buy(spark):
    flags = spark.createDataFrame([("1",), ("2",), ("9",), ("",)], "f string")
    labels = [row[0] for row in flags.select(side_label(F.col("f"))).collect()]
    assert labels == ["SELL", "BUY", "BUY", "BUY"]


def test_normalised_trade(spark):
    normal = normalize_trades(trades_frame(spark, [trade("10:00:59", 7.0, ID="x", TSYM="USDT")]))
    assert types_of(normal.schema) == types_of(NORMAL_TRADE)
    assert tuple(normal.first()) == (
        "x", "BTC", "USDT", "Coinbase", "BUY", at("10:00:59"), 2.0, 14.0, 7.0,
    )


@pytest.mark.parametrize(
    ("clock", "period", "start", "end"),
    [
        ("10:01:00", 60, "10:01:00", "10:02:00"),
        ("10:00:59", 60, "10:00:00", "10:01:00"),
        ("10:07:10", 300, "10:05:00", "10:10:00"),
        ("10:07:10", 3600, "10:00:00", "11:00:00"),
    ],
)
def test_window_edges(spark, clock, period, start, end):
    normal = normalize_trades(trades_frame(spark, [trade(clock)]))
    row = assign_window(normal, period).first()
    assert (row.window_start, row.window_end) == (at(start), at(end))


def test_totals_of_one_window(spark):
    rows = [trade("10:00:01", 100.0), trade("10:00:02", 101.0, Q=1.0, TOTAL=101.0)]
    totals = window_totals(trades_frame(spark, rows))
    assert types_of(totals.schema) == types_of(TOTALS)
    assert [tuple(row) for row in totals.collect()] == [
        (
            at("00:00:00"), at("10:00:00"), at("10:01:00"), "Coinbase", "BUY", "BTC", "USD",
            301.0, 100.5, 3.0, 2,
        )
    ]


def test_a_window_that_ends_at_midnight_belongs_to_the_next_day(spark):
    row = window_totals(trades_frame(spark, [trade("23:59:30")])).first()
    assert row.window_end == at("00:00:00", "2021-01-09")
    assert row.date == at("00:00:00", "2021-01-09")


def test_quote_currencies_are_mixed_under_one_label(spark):
    rows = [trade(TSYM="USD"), trade(TSYM="USDT")]
    totals = window_totals(trades_frame(spark, rows))
    assert [(r.tocurrency, r.counttxns) for r in totals.collect()] == [("USD", 2)]
    other = window_totals(trades_frame(spark, rows), currency="EUR")
    assert other.first().tocurrency == "EUR"


def test_market_coin_and_side_are_apart(spark):
    rows = [trade(), trade(FSYM="ETH"), trade(M="Kraken"), trade(F="1"), trade("10:01:00")]
    assert window_totals(trades_frame(spark, rows)).count() == 5


def test_duplicates_count_twice(spark):
    assert window_totals(trades_frame(spark, [trade(ID="7"), trade(ID="7")])).first().counttxns == 2


def test_fewer_partitions_same_result(spark):
    rows = trades_frame(spark, [trade(ID=str(i)) for i in range(40)]).repartition(8)
    assert window_totals(rows, max_partitions=2).first().counttxns == 40


def test_subscribed_channels(spark):
    rows = trades_frame(
        spark,
        [
            trade(ID="1"),
            trade(ID="2", M="Binance", TSYM="USDT"),
            trade(ID="3", M="Binance", TSYM="USD"),
            trade(ID="4", M="Elsewhere"),
            trade(ID="5", FSYM="ETH"),
        ],
    )
    assert {row.ID for row in subscribed_trades(rows, DEFAULT_CHANNELS).collect()} == {"1", "2"}
    table = spark.createDataFrame([("0~Elsewhere~BTC~USD",)] * 3, "channel string")
    assert [row.ID for row in subscribed_trades(rows, table).collect()] == ["4"]
    assert subscribed_trades(rows, []).count() == 0


def test_only_channels_of_trades_count(spark):
    rows = trades_frame(spark, [trade()])
    assert subscribed_trades(rows, ["2~Coinbase~BTC~USD"]).count() == 0
    with pytest.raises(ValueError, match="BTC"):
        subscribed_trades(rows, ["Coinbase~BTC~USD"])
    names = ["Coinbase~BTC~USD", "0~Coinbase~BTC~USD~x", "0~~BTC~USD", "0~Coinbase", None, ""]
    table = spark.createDataFrame([(name,) for name in names], "channel string")
    assert subscribed_trades(rows, table).count() == 0


