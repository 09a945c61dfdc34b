"""JSON text to rows: strict, never failing, and parsed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from tapeline import schemas

# Standard JSON only: Spark by default also takes 'single quotes' and NaN.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

# TS must be a time Spark can hold (years 1 to 9999); beyond that the cast to a timestamp
# overflows and would stop the job.
_MIN_SECONDS = -62135596800
_MAX_SECONDS = 253402300799


def parsed_documents(text: Column, schema: StructType) -> Column:
    """Generator column: the JSON documents in `text`, as one array per input row.

    The text is wrapped in brackets, so anything after the first document shows as a broken
    array or a second element instead of being ignored.

    The result comes out of a generator on purpose. A plain `from_json` column is copied into
    every filter that the optimizer pushes below it, and the text is then parsed once per
    copy; a filter cannot move below a generator, so here each text is parsed exactly once.
    """
    bracketed = F.concat(F.lit("["), text, F.lit("]"))
    return F.explode(F.array(F.from_json(bracketed, ArrayType(schema), _STRICT)))


def only_document(documents: Column) -> Column:
    """The document if there is exactly one, else null."""
    return F.when(F.size(documents) == 1, F.get(documents, F.lit(0)))


def is_message(documents: Column, message: StructType) -> Column:
    """True for a single document that holds every field of the message with a usable value."""
    document = F.get(documents, F.lit(0))
    return (F.size(documents) == 1) & has_fields(document.getField, message)


def has_fields(field_of: Callable[[str], Column], message: StructType) -> Column:
    """Whether every field is there and usable: the one rule for text and for stored rows."""
    fits = F.lit(True)
    for field in message:
        fits = fits & field_of(field.name).isNotNull()
        if isinstance(field.dataType, DoubleType):
            fits = fits & ~F.isnan(field_of(field.name))
    if message is schemas.TRADE:
        fits = fits & field_of("TS").between(_MIN_SECONDS, _MAX_SECONDS)
    return fits


def pick_fields(document: Column, message: StructType) -> list[Column]:
    return [document.getField(field.name).alias(field.name) for field in message]
