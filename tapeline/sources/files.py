"""Trades and frames from files, as a batch or as a stream of newly arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.functions.json_text import has_fields
from tapeline.operators.records import decode_records, decoded_trades, observe_decode
from tapeline.schemas import TRADE


def read_lines(
    spark: SparkSession, path: str, *, stream: bool = True, **options: str | int
) -> DataFrame:
    """One row per line, column `value`: the raw frames of a landing folder.

    Pass `maxFilesPerTrigger` or `maxBytesPerTrigger` to bound a micro-batch.
    """
    reader = spark.readStream if stream else spark.read
    return reader.options(**options).text(path)


def read_trades(
    spark: SparkSession,
    path: str,
    *,
    file_format: str = "json",
    stream: bool = True,
    metric: str = "decode",
    **options: str | int,
) -> DataFrame:
    """Trade rows from JSON lines, Parquet or ORC, by one rule: all fields there and usable.

    Rows that are not are left out; `read_lines` and `rejected_records`, or `rejected_trades`, give
    them. A stream counts them, as the query metrics `accepted` and `rejected` under the name
    `metric`. A batch does not, as filters could then not reach the files.
    """
    if file_format == "json":
        rows = decode_records(read_lines(spark, path, stream=stream, **options))
    elif stream:
        rows = _stored_trades(spark, path, file_format, stream, **options)
    else:
        rows = spark.read.schema(TRADE).options(**options).format(file_format).load(path)
        return rows.where(has_fields(F.col, TRADE))
    return decoded_trades(observe_decode(rows, metric) if stream else rows)


def rejected_trades(
    spark: SparkSession, path: str, *, file_format: str, stream: bool = True, **options: str | int
) -> DataFrame:
    """Rows of Parquet or ORC files that are no complete trade, as they are."""
    rows = _stored_trades(spark, path, file_format, stream, **options)
    return rows.where(F.col("trade").isNull()).drop("trade")


def _stored_trades(
    spark: SparkSession, path: str, file_format: str, stream: bool, **options: str | int
) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    rows = reader.schema(TRADE).options(**options).format(file_format).load(path)
    usable = has_fields(F.col, TRADE)
    return rows.withColumn("trade", F.when(usable, F.struct(*TRADE.fieldNames())))
