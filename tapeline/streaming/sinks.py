"""Sinks: console, change log, served table, any batch connector, topic."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tapeline.functions.uuids import time_uuid
from tapeline.operators.served import latest_rows, served_order
from tapeline.schemas import CHANGE_LOG, SERVED
from tapeline.streaming import manifests
from tapeline.streaming.runs import session_settings

BatchFunction = Callable[[DataFrame, int], None]

# How long a folder that is live no more stays for readers that have listed it.
RETAIN_SECONDS = 3600

_IDENTITY = ("window_end", "window_start", "direction", "market", "fromcoin")


def with_row_ids(totals: DataFrame) -> DataFrame:
    """Add `batch_ms`, the time of the micro-batch, and `uuid`, made from it.

    Use it on the stream, before `writeStream`: the time of a micro-batch is in the checkpoint,
    so a batch that is run again writes the same time and the same ids.
    """
    return totals.withColumn("batch_ms", F.unix_millis(F.current_timestamp())).withColumn(
        "uuid", time_uuid(F.col("batch_ms"), *[F.col(name) for name in _IDENTITY])
    )


def console_writer(totals: DataFrame, rows: int = 50) -> DataStreamWriter:
    return (
        totals.writeStream.format("console")
        .option("truncate", "false")
        .option("numRows", str(rows))
        .outputMode("update")
    )


def topic_writer(
    records: DataFrame, servers: str, topic: str, **options: str | int
) -> DataStreamWriter:
    """Needs Spark's Kafka connector. Spark batches the sends; a failed send fails the task."""
    return (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
        .outputMode("append")
    )


def append_to(file_format: str, **options: str) -> BatchFunction:
    """Batch function that appends every update to a table of any batch connector.

    A batch that is run again is appended again, so the table must itself replace rows by key. Rows
    have the columns of the totals and, if they were given one, the id.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.drop("batch_ms").write.format(file_format).options(**options).mode("append").save()

    return write


def append_to_log(path: str, by_date: bool = False) -> BatchFunction:
    """Batch function that writes every update batch to a change log.

    Each batch has its own folder, which is replaced as a whole: a batch that is run again
    rewrites its rows instead of doubling them. Rows lie in date order in few files, sized by
    adaptive execution, so that a filter on `date` skips by Parquet statistics.

    With `by_date` there are folders by date above those of the batches, and a filter on `date`
    reads only its folder. That suits a live feed, whose batches hold one or two dates; a backfill
    would open one file per date and batch. The table made by `fold_log` is by date in any case.
    """
    folders = [*(["date"] if by_date else []), "batch_ms", "batch_id"]

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).withColumn(
            "date", F.col("date").cast("date")
        )
        (
            rows.select(*CHANGE_LOG.fieldNames())
            .hint("rebalance", "date")
            .sortWithinPartitions(*folders, "date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*folders)
            .parquet(path)
        )

    return write


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a change log."""
    return spark.read.schema(CHANGE_LOG).parquet(path)


def fold_log(
    spark: SparkSession,
    log: str,
    table: str,
    first: str | None = None,
    last: str | None = None,
    retain_seconds: float = RETAIN_SECONDS,
) -> int | None:
    """Bring the served table up to date with the log, for the dates `first` to `last` or for all.

    Of every date that the log has rows of, the latest rows of log and table together are written as
    a new generation of that date, which a manifest then makes the live one of all these dates at
    once. Nothing is read and replaced at the same place, so whenever the job stops, no row is lost, and
    it can be run again; if another fold commits first, this one starts again from what that left.
    Folders that are live no more stay for readers that have listed them, `retain_seconds` long.

    Rows of a date lie in the served order, in files and row groups that each hold a range of windows.
    Returns the time of the last batch that is now in the table: after a fold of all dates,
    `drop_folded` may remove the log up to there.
    """
    rows = read_log(spark, log)
    if first is not None:
        rows = rows.where(F.col("date") >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col("date") <= F.lit(last).cast("date"))
    # A date per day of the calendar that changed.
    upto, changed = rows.agg(F.max("batch_ms"), F.collect_set(F.col("date").cast("string"))).first()
    if upto is None:
        return None
    while True:
        held = manifests.latest(spark, table)
        new = rows.where(F.col("batch_ms") <= upto)
        if held.version < 0 and _paths(spark, f"{table}/generation=*"):
            # A table from before there were manifests: all its dates move to the first one.
            new = new.unionByName(_generations(spark, table).select(*CHANGE_LOG.fieldNames()))
        elif kept := held.folders(changed):
            new = new.unionByName(_live(spark, table, kept).select(*CHANGE_LOG.fieldNames()))
        name = f"generation={upto:020d}-{uuid.uuid4().hex}"
        order = ["date", *served_order()]
        with session_settings(spark, {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}):
            (
                latest_rows(new)
                .repartitionByRange(*order)
                .sortWithinPartitions(*order)
                .write.partitionBy("date")
                .parquet(f"{table}/{name}")
            )
        written = [path.rpartition("/")[2] for path in _paths(spark, f"{table}/{name}/date=*")]
        live = {date.removeprefix("date="): f"{name}/{date}" for date in written}
        everything = upto if first is None and last is None else None
        if manifests.commit(spark, table, held.after(live, everything)):
            break
        manifests.remove(spark, f"{table}/{name}")
    manifests.expire(spark, table, retain_seconds)
    return upto


def drop_folded(spark: SparkSession, log: str, upto: int) -> None:
    """Remove the batches of a log up to a time, once all their dates are in the table."""
    for path in [*_paths(spark, f"{log}/batch_ms=*"), *_paths(spark, f"{log}/date=*/batch_ms=*")]:
        if int(path.rpartition("=")[2]) <= upto:
            manifests.remove(spark, path)


def keep_table(
    log: str, table: str, every: int = 40, retain_seconds: float = RETAIN_SECONDS
) -> BatchFunction:
    """Batch function that keeps a served table: a log, folded into the table every few batches.

    `read_served` has the latest rows at any time, folded or not. Batches leave the log once they have
    been in the table for `retain_seconds`, so a reader that began before a fold can end after it.
    """
    append = append_to_log(log)

    def write(batch: DataFrame, batch_id: int) -> None:
        append(batch, batch_id)
        if batch_id % every == every - 1:
            spark = batch.sparkSession
            fold_log(spark, log, table, retain_seconds=retain_seconds)
            upto = manifests.expire(spark, table, retain_seconds)
            if upto is not None:
                drop_folded(spark, log, upto)

    return write


def read_table(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """The rows as of the last fold, of one date or of all: a scan, as every key is there once."""
    held = manifests.latest(spark, path)
    if held.version < 0:
        return latest_rows(_generations(spark, path))
    return _live(spark, path, held.folders(None if day is None else [day]))


def read_served(spark: SparkSession, log: str, table: str) -> DataFrame:
    """The latest rows of table and unfolded log. A filter on `date` reaches both."""
    parts = []
    held = manifests.latest(spark, table)
    if held.version >= 0:
        parts.append(_live(spark, table, held.folders()))
    elif _paths(spark, f"{table}/generation=*"):
        parts.append(_generations(spark, table))
    if _paths(spark, f"{log}/*=*"):
        parts.append(read_log(spark, log))
    if not parts:
        return spark.createDataFrame([], SERVED)
    rows = [part.select(*CHANGE_LOG.fieldNames()) for part in parts]
    return latest_rows(rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1]))


def _generations(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(SERVED).parquet(table).select(*SERVED.fieldNames())


def _live(spark: SparkSession, table: str, folders: list[str]) -> DataFrame:
    """Rows of some folders of a table. They are listed now, so later folds do not matter."""
    if not folders:
        return spark.createDataFrame([], SERVED)
    read = spark.read.schema(SERVED).option("basePath", table)
    return read.parquet(*[f"{table}/{folder}" for folder in folders]).select(*SERVED.fieldNames())


def _paths(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match, by Spark's own file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = files.globStatus(path)
    return [status.getPath().toString() for status in found or [] if status.isDirectory()]
