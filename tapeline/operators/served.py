"""The served table: latest row per key, kept by date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.schemas import SERVED, TOTALS

SERVED_KEY = ("date", "window_end", "window_start", "direction", "market", "fromcoin")

# The narrower key, in which two coins of one market overwrite each other.
MARKET_KEY = ("date", "window_end", "window_start", "direction", "market")


# Bits of a batch's order that tell batches of one millisecond apart.
_BATCH_BITS = 20
# Bytes of a currency label that two numbers hold.
_LABEL_BYTES = 16


def batch_order(batch_ms: Column, batch_id: Column) -> Column:
    """The order of batches as one number: time, then the last bits of the id."""
    return batch_ms * (1 << _BATCH_BITS) + F.pmod(batch_id, F.lit(1 << _BATCH_BITS))


def _number(digits: Column) -> Column:
    """Up to 16 hex digits as a signed 64-bit number; null for none."""
    return F.conv(F.nullif(digits, F.lit("")), 16, -10).cast("bigint")


def _id_numbers(uuid: Column) -> list[Column]:
    digits = F.when(F.length(uuid) == 36, F.translate(uuid, "-", ""))
    return [_number(F.substring(digits, 1, 16)), _number(F.substring(digits, 17, 16))]


def _id_text(high: Column, low: Column) -> Column:
    digits = F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    # concat, as concat_ws leaves nulls out.
    parts = [F.substring(digits, at, n) for at, n in cuts]
    return F.concat(*[x for part in parts for x in (F.lit("-"), part)][1:])


def _label_numbers(label: Column) -> list[Column]:
    too_long = F.raise_error(F.concat(F.lit("a currency label has 16 bytes at most: "), label))
    digits = F.when(F.octet_length(label) > _LABEL_BYTES, too_long).otherwise(F.hex(F.encode(label, "UTF-8")))
    return [_number(F.substring(digits, 1, 16)), _number(F.substring(digits, 17, 16))]


def _label_text(first: Column, rest: Column) -> Column:
    digits = F.concat(F.hex(first), F.coalesce(F.hex(rest), F.lit("")))
    return F.decode(F.unhex(digits), "UTF-8")


def latest_rows(change_log: DataFrame, key: Sequence[str] = SERVED_KEY) -> DataFrame:
    """The last row written for every key of a change log.

    Order is batch time, then batch id: batch ids start again at 0 under a new checkpoint, batch
    times do not. Under the narrow key the coin breaks ties, so that the result is stable.

    All that is carried per key is numbers of fixed width, so both aggregations hash and none sorts:
    batch order is one number, id and label are two each. An id that is no UUID comes out null.
    """
    order = batch_order(F.col("batch_ms"), F.col("batch_id"))
    id_high, id_low = _id_numbers(F.col("uuid"))
    label, label_rest = _label_numbers(F.col("tocurrency"))
    carried = {
        "totalvol": F.col("totalvol"),
        "avgprice": F.col("avgprice"),
        "totalquantity": F.col("totalquantity"),
        "counttxns": F.col("counttxns"),
        "batch_ms": F.col("batch_ms"),
        "batch_id": F.col("batch_id"),
        "_id_high": id_high,
        "_id_low": id_low,
        "_label": label,
        "_label_rest": label_rest,
    }
    latest = (
        change_log.groupBy(*SERVED_KEY)
        .agg(*[F.max_by(value, order).alias(name) for name, value in carried.items()])
        .withColumn("uuid", _id_text(F.col("_id_high"), F.col("_id_low")))
        .withColumn("tocurrency", _label_text(F.col("_label"), F.col("_label_rest")))
        .select(*SERVED.fieldNames())
    )
    if set(key) == set(SERVED_KEY):
        return latest
    rest = [name for name in SERVED.fieldNames() if name not in key]
    written = F.struct("batch_ms", "batch_id", "fromcoin")
    narrowed = latest.groupBy(*key).agg(F.max_by(F.struct(*rest), written).alias("row"))
    return narrowed.select(*key, "row.*").select(*SERVED.fieldNames())


def as_totals(served: DataFrame, with_uuid: bool = False) -> DataFrame:
    """Served rows with `date` as the midnight timestamp."""
    columns = TOTALS.fieldNames() + (["uuid"] if with_uuid else [])
    return served.withColumn("date", F.col("date").cast("timestamp")).select(*columns)


def served_order() -> list[Column]:
    """Newest window first, as within a date of the served table."""
    return [
        F.col("window_end").desc(),
        F.col("window_start").desc(),
        F.col("direction").asc(),
        F.col("market").asc(),
        F.col("fromcoin").asc(),
    ]


def rows_of_date(served: DataFrame, day: str) -> DataFrame:
    """All windows of one date, newest first. On the served table only its folder is read."""
    return served.where(F.col("date") == F.lit(day).cast("date")).orderBy(*served_order())


def rows_of_windows(served: DataFrame, first: str, last: str) -> DataFrame:
    """Windows that end after `first` and not after `last` (times in the session's zone), newest first.

    Dates are those of window ends, so only folders of the dates in between are read, and of those only
    the row groups that hold windows of the range.
    """
    end, since, until = F.col("window_end"), *(F.lit(t).cast("timestamp") for t in (first, last))
    days = F.col("date").between(since.cast("date"), until.cast("date"))
    return served.where(days & (end > since) & (end <= until)).orderBy(*served_order())
