"""What a checkpoint holds: the open groups of a query of totals, read back as a table.

Spark's state data source reads the state store of a batch where it lies; nothing is replayed and the query
may be running. The groups can be looked at, or carried to a checkpoint of another shuffle width, see
`carried_groups`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.operators.normalize import WINDOW_SECONDS
from tapeline.streaming.stateful import KEY, SUMS

GROUP_COLUMNS = [*KEY, *SUMS]


def _read(spark: SparkSession, checkpoint: str, variable: str | None, batch_id: int | None) -> DataFrame:
    reader = spark.read.format("statestore")
    if variable is not None:
        reader = reader.option("stateVarName", variable)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def _is_stateful(spark: SparkSession, checkpoint: str) -> bool:
    names = spark.read.format("state-metadata").load(checkpoint).select("operatorName").distinct()
    # A row per stateful operator of the query.
    return any(row.operatorName.startswith("transformWithState") for row in names.collect())


def native_groups(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Open groups of `window_totals`: key, `window_seconds` and sums.

    Groups whose window the watermark has passed are not there.
    """
    sums = "struct<vol: double, price: double, price_n: bigint, quantity: double, n: bigint>"
    rows = _read(spark, checkpoint, None, batch_id).select(
        "key.*", F.col("value").cast(sums).alias("sums")
    )
    seconds = F.unix_seconds("window.start").alias("window_seconds")
    return rows.select("market", "fromcoin", "direction", seconds, *[f"sums.{name}" for name in SUMS])


def stateful_groups(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Open groups of `stateful_totals`: key, sums and `timeout_ms`, each group as last changed.

    Groups that have been forgotten are not there. Of entries of one group the one with the latest
    timeout counts, of those the one with the most trades, as a group only grows until it is forgotten.
    """
    entry = F.col("list_element")
    changed = _read(spark, checkpoint, "changes", batch_id).select(
        F.col("key.bucket").alias("bucket"),
        entry["timeout_ms"].alias("timeout_ms"),
        F.inline(F.arrays_zip(*[entry[name].alias(name) for name in GROUP_COLUMNS])),
    )
    marks = _read(spark, checkpoint, "marks", batch_id).select(
        F.col("key.bucket").alias("bucket"), "value.forgotten_ms"
    )
    order = F.struct("timeout_ms", "n")
    last = changed.groupBy("bucket", *KEY).agg(
        F.max_by(F.struct(*SUMS, "timeout_ms"), order).alias("last")
    )
    open_now = last.join(marks, "bucket").where(F.col("last.timeout_ms") > F.col("forgotten_ms"))
    return open_now.select(*KEY, "last.*")


def open_groups(
    spark: SparkSession,
    checkpoint: str,
    period_seconds: int = WINDOW_SECONDS,
    batch_id: int | None = None,
) -> DataFrame:
    """The groups that a query of totals, of either kind, holds open after its last batch or a given one.

    Columns: window_start, window_end, market, direction, fromcoin, totalvol, avgprice, totalquantity,
    counttxns. Reading goes by partitions of the state store.
    """
    read = stateful_groups if _is_stateful(spark, checkpoint) else native_groups
    start = F.col("window_seconds")
    return read(spark, checkpoint, batch_id).select(
        F.timestamp_seconds(start).alias("window_start"),
        F.timestamp_seconds(start + period_seconds).alias("window_end"),
        "market",
        "direction",
        "fromcoin",
        F.col("vol").alias("totalvol"),
        (F.col("price") / F.col("n")).alias("avgprice"),
        F.col("quantity").alias("totalquantity"),
        F.col("n").alias("counttxns"),
    )


def carried_groups(spark: SparkSession, checkpoint: str, folder: str) -> DataFrame:
    """Open groups of a stopped query of `stateful_totals`, stored in `folder`, for its `carried`.

    The new query takes them into a checkpoint of its own, of any shuffle width, and goes on as the old
    one would have: its source has to begin where the old one's ended.
    """
    stateful_groups(spark, checkpoint).write.parquet(folder)
    return spark.read.parquet(folder)
