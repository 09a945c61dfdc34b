"""Scalar columns of a trade."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Side flags on the feed and the labels they get.
SELL_FLAG = "1"
BUY_FLAG = "2"
SELL = "SELL"
BUY = "BUY"

# Fixed value: first part of a record key.
RECORD_KEY_PREFIX = "WSTradeMsg"


def has_side(flag: Column) -> Column:
    """True for buys and sells. A plain IN list, so that it can reach a columnar scan."""
    return flag.isin(SELL_FLAG, BUY_FLAG)


def side_label(flag: Column) -> Column:
    """SELL for the sell flag, BUY for anything else."""
    return F.when(flag == SELL_FLAG, SELL).otherwise(BUY)


def event_time(epoch_seconds: Column) -> Column:
    return F.timestamp_seconds(epoch_seconds)


def window_of(timestamp: Column, period_seconds: int) -> Column:
    """The epoch-aligned half-open window [start, end) that holds `timestamp`."""
    return F.window(timestamp, f"{int(period_seconds)} seconds")


def date_bucket(window_end: Column) -> Column:
    """Midnight of the window's end: a window that ends at midnight belongs to the next day."""
    return F.date_trunc("day", window_end)


def record_key(flag: Column, market: Column) -> Column:
    return F.concat_ws("-", F.lit(RECORD_KEY_PREFIX), flag, market)
