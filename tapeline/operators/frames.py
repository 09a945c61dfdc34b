"""Feed frames: tell the message kinds apart, route trades, set the rest aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions.json_text import is_message, only_document, parsed_documents, pick_fields
from tapeline.schemas import FRAME, MESSAGES, TRADE

MALFORMED = "malformed"


def classify_frames(frames: DataFrame, text: str = "value") -> DataFrame:
    """Add `kind` and the decoded `message` to every frame; the raw text stays.

    The kind is the first message whose fields are all present. A frame that fits none is
    `malformed`; it is kept, so that nothing is lost and nothing stops the stream.
    """
    parsed = frames.select(
        "*", parsed_documents(F.col(text).cast("string"), FRAME).alias("_documents")
    )
    documents = F.col("_documents")
    kind: Column | None = None
    for name, fields in MESSAGES.items():
        fits = is_message(documents, fields)
        kind = F.when(fits, name) if kind is None else kind.when(fits, name)
    return parsed.select(
        *[F.col(name) for name in frames.columns],
        kind.otherwise(MALFORMED).alias("kind"),
        only_document(documents).alias("message"),
    )


def trades_of(classified: DataFrame) -> DataFrame:
    """The trades among classified frames, as trade rows."""
    return classified.where(F.col("kind") == "trade").select(
        *pick_fields(F.col("message"), TRADE)
    )


def quarantine_of(classified: DataFrame) -> DataFrame:
    """Frames that fit no message, with their raw text."""
    return classified.where(F.col("kind") == MALFORMED).drop("message")


def service_messages(classified: DataFrame) -> DataFrame:
    """Start messages and refused keys, with their text; `info` says why a key was refused."""
    kinds = F.col("kind").isin("start", "wrong_api_key")
    others = [name for name in classified.columns if name not in ("kind", "message", "value")]
    return classified.where(kinds).select(
        *others,
        "kind",
        F.col("message.MESSAGE").alias("text"),
        F.col("message.PARAMETER").alias("parameter"),
        F.col("message.INFO").alias("info"),
    )


def count_kinds(classified: DataFrame) -> DataFrame:
    """Frames per kind. A kind with most of the frames is combined before the shuffle."""
    return classified.groupBy("kind").agg(F.count("*").alias("frames"))


def observe_kinds(classified: DataFrame, name: str = "frame_kinds") -> DataFrame:
    """Report frames per kind as query metrics, in the pass that is being made anyway."""
    counts = [
        F.count_if(F.col("kind") == kind).alias(kind) for kind in (*MESSAGES, MALFORMED)
    ]
    return classified.observe(name, *counts)
