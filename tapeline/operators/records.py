"""Topic records: a string key and a trade as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.functions.json_text import is_message, only_document, parsed_documents, pick_fields
from tapeline.functions.trades import record_key
from tapeline.schemas import TRADE


def encode_records(trades: DataFrame) -> DataFrame:
    """Trades to `key`, `value`: the value is the whole trade as JSON."""
    return trades.select(
        record_key(F.col("F"), F.col("M")).alias("key"),
        F.to_json(F.struct(*TRADE.fieldNames())).alias("value"),
    )


def decode_records(records: DataFrame, value: str = "value") -> DataFrame:
    """Add `trade` to every record, null where the value is no complete trade."""
    parsed = records.select(
        "*", parsed_documents(F.col(value).cast("string"), TRADE).alias("_documents")
    )
    documents = F.col("_documents")
    return parsed.select(
        *[F.col(name) for name in records.columns],
        F.when(is_message(documents, TRADE), only_document(documents)).alias("trade"),
    )


def decoded_trades(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("trade").isNotNull()).select(*pick_fields(F.col("trade"), TRADE))


def rejected_records(decoded: DataFrame) -> DataFrame:
    """Records whose value is no complete trade, as they came."""
    return decoded.where(F.col("trade").isNull()).drop("trade")


def observe_decode(decoded: DataFrame, name: str = "decode") -> DataFrame:
    """Report accepted and rejected records as query metrics, in the same pass."""
    return decoded.observe(
        name,
        F.count_if(F.col("trade").isNotNull()).alias("accepted"),
        F.count_if(F.col("trade").isNull()).alias("rejected"),
    )
