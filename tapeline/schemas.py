"""Row types, stated as constants so that no reader ever infers a schema."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {"string": StringType(), "long": LongType(), "double": DoubleType()}


def _fields(**columns: str) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in columns.items()])


# Field names and types of the messages on the feed.
TRADE = _fields(
    TYPE="string", M="string", FSYM="string", TSYM="string", F="string", ID="string",
    TS="long", Q="double", P="double", TOTAL="double", RTS="long",
)
START = _fields(
    TYPE="string", MESSAGE="string", SERVER_UPTIME_SECONDS="long", SERVER_TIME_MS="long",
    CLIENT_ID="long", SOCKET_ID="string", RATELIMIT_MAX_DAY="long",
    RATELIMIT_REMAINING_DAY="long", RATELIMIT_MAX_MINUTE="long",
    RATELIMIT_REMAINING_MINUTE="long",
)
INFO = _fields(TYPE="string", MESSAGE="string", TIMEMS="long")
TICKER = _fields(
    TYPE="string", MARKET="string", FROMSYMBOL="string", TOSYMBOL="string", FLAGS="long",
    PRICE="double", LASTUPDATE="long", LASTVOLUME="double", VOLUMEDAY="double",
)
WRONG_API_KEY = _fields(TYPE="string", MESSAGE="string", PARAMETER="string", INFO="string")

# Message kinds in the order in which they are tried. A frame takes the first kind whose
# fields it has; the TYPE code plays no part.
MESSAGES = {
    "start": START,
    "info": INFO,
    "trade": TRADE,
    "ticker": TICKER,
    "wrong_api_key": WRONG_API_KEY,
}

# Every field of every message. No name is used with two types, so one parse serves all kinds.
FRAME = StructType(
    list({field.name: field for message in MESSAGES.values() for field in message}.values())
)

# Names and types of normalised trades and of results.
NORMAL_TRADE = StructType([
    StructField("id", StringType()),
    StructField("fromcoin", StringType()),
    StructField("tocurrency", StringType()),
    StructField("market", StringType()),
    StructField("direction", StringType()),
    StructField("timestamp", TimestampType()),
    StructField("quantity", DoubleType()),
    StructField("vol", DoubleType()),
    StructField("price", DoubleType()),
])

TOTALS = StructType([
    StructField("date", TimestampType()),
    StructField("window_start", TimestampType()),
    StructField("window_end", TimestampType()),
    StructField("market", StringType()),
    StructField("direction", StringType()),
    StructField("fromcoin", StringType()),
    StructField("tocurrency", StringType()),
    StructField("totalvol", DoubleType()),
    StructField("avgprice", DoubleType()),
    StructField("totalquantity", DoubleType()),
    StructField("counttxns", LongType()),
])

# Stored rows keep `date` as a DATE: it names the folder, free of any time zone. They keep the order
# in which they were written, so that later rows can be told from earlier ones wherever they lie.
SERVED = StructType(
    [field for field in TOTALS if field.name != "date"]
    + [StructField("uuid", StringType())]
    + [StructField("batch_ms", LongType()), StructField("batch_id", LongType())]
    + [StructField("date", DateType())]
)
CHANGE_LOG = StructType(
    [field for field in SERVED if not field.name.startswith("batch_")]
    + [StructField("batch_ms", LongType()), StructField("batch_id", LongType())]
)
