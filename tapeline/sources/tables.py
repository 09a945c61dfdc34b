"""The event and order-line tables seen as trades, feed frames and topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions.trades import record_key
from tapeline.schemas import INFO, START, TICKER, TRADE, WRONG_API_KEY

# Markets by number, the coin, and the currencies.
MARKETS = ("Coinbase", "Binance", "Kraken", "CoinDeal", "Gemini")
COIN = "BTC"


def _trade(
    source: DataFrame,
    *,
    number: Column,
    sell: Column,
    buy: Column,
    trade_id: Column,
    seconds: Column,
    quantity: Column,
    price: Column,
    keep: tuple[str, ...],
) -> DataFrame:
    market = F.get(F.array(*[F.lit(name) for name in MARKETS]), F.pmod(number, F.lit(len(MARKETS))))
    return source.select(
        *keep,
        F.lit("0").alias("TYPE"),
        market.alias("M"),
        F.lit(COIN).alias("FSYM"),
        F.when(market == "Binance", "USDT").otherwise("USD").alias("TSYM"),
        F.when(sell, "1").when(buy, "2").otherwise("4").alias("F"),
        trade_id.alias("ID"),
        seconds.alias("TS"),
        quantity.alias("Q"),
        price.alias("P"),
        (quantity * price).alias("TOTAL"),
        seconds.alias("RTS"),
    )


def events_as_trades(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A purchase is a sell, a click a buy; other events have no side."""
    return _trade(
        events,
        number=F.col("user_id"),
        sell=F.col("event_type") == "purchase",
        buy=F.col("event_type") == "click",
        trade_id=F.col("event_id").cast("string"),
        seconds=F.unix_seconds(F.col("ts").cast("timestamp")),
        quantity=F.get_json_object("props", "$.k").try_cast("double"),
        price=F.col("value"),
        keep=keep,
    )


def lineitem_as_trades(lineitem: DataFrame) -> DataFrame:
    """A returned line is a sell, an accepted one a buy; its time is the ship date."""
    return _trade(
        lineitem,
        number=F.col("l_suppkey"),
        sell=F.col("l_returnflag") == "R",
        buy=F.col("l_returnflag") == "A",
        trade_id=F.concat_ws("-", "l_orderkey", "l_linenumber"),
        seconds=F.unix_seconds(F.col("l_shipdate").cast("timestamp")),
        quantity=F.col("l_quantity"),
        price=F.col("l_extendedprice"),
        keep=(),
    )


def _json(message, **values: Column) -> Column:
    return F.to_json(
        F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in message])
    )


def events_as_frames(events: DataFrame) -> DataFrame:
    """Every event as one feed frame (`event_id`, `value`).

    Purchases and clicks give trades, views tickers, sign-ups service messages; an error gives a
    trade cut off before its last brace.
    """
    trades = events_as_trades(events, keep=("event_id", "event_type"))
    trade = _json(TRADE, **{name: F.col(name) for name in TRADE.fieldNames()})
    number = F.col("event_id")
    start = _json(
        START, TYPE=F.lit("20"), MESSAGE=F.lit("welcome"),
        SERVER_UPTIME_SECONDS=number, SERVER_TIME_MS=F.col("TS") * 1000, CLIENT_ID=number,
        SOCKET_ID=F.col("ID"), RATELIMIT_MAX_DAY=F.lit(10000),
        RATELIMIT_REMAINING_DAY=F.lit(9999), RATELIMIT_MAX_MINUTE=F.lit(100),
        RATELIMIT_REMAINING_MINUTE=F.lit(99),
    )
    info = _json(INFO, TYPE=F.lit("999"), MESSAGE=F.lit("heartbeat"), TIMEMS=F.col("TS") * 1000)
    wrong_key = _json(
        WRONG_API_KEY, TYPE=F.lit("401"), MESSAGE=F.lit("refused"),
        PARAMETER=F.lit("api_key"), INFO=F.lit("The key is not valid"),
    )
    ticker = _json(
        TICKER, TYPE=F.lit("2"), MARKET=F.col("M"), FROMSYMBOL=F.col("FSYM"),
        TOSYMBOL=F.col("TSYM"), FLAGS=F.lit(1), PRICE=F.col("P"), LASTUPDATE=F.col("TS"),
        LASTVOLUME=F.col("Q"), VOLUMEDAY=F.col("TOTAL"),
    )
    kind = F.col("event_type")
    turn = F.pmod(number, F.lit(50))
    frame = (
        F.when(kind == "view", ticker)
        .when((kind == "signup") & (turn == 0), start)
        .when((kind == "signup") & (turn == 25), wrong_key)
        .when(kind == "signup", info)
        .when(kind == "error", F.expr("substring(_trade, 1, length(_trade) - 1)"))
        .otherwise(F.col("_trade"))
    )
    return trades.withColumn("_trade", trade).select("event_id", frame.alias("value"))


def events_as_records(events: DataFrame) -> DataFrame:
    """Every event as one topic record, in the shape of a Kafka source.

    The value of an error event is cut off before its last brace.
    """
    trades = events_as_trades(events, keep=("event_id", "event_type"))
    value = F.to_json(F.struct(*TRADE.fieldNames()))
    cut = F.when(F.col("event_type") == "error", F.expr("substring(_json, 1, length(_json) - 1)"))
    return (
        trades.withColumn("_json", value)
        .withColumn("value", cut.otherwise(F.col("_json")).cast("binary"))
        .withColumn("key", record_key(F.col("F"), F.col("M")).cast("binary"))
        .select(
            "key",
            "value",
            F.lit("trades").alias("topic"),
            F.lit(0).alias("partition"),
            F.col("event_id").alias("offset"),
            F.timestamp_seconds("TS").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )
    )
