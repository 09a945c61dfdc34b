"""What several operators share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.streaming.runs import work_folder

# Words are runs of characters other than space and the five control characters from tab to return.
SPACE = r"[\x20\x09-\x0D]+"


def stored(rows: DataFrame, name: str, **options: str) -> DataFrame:
    """Rows written to a new folder that all executors share, and read back.

    Cuts the lineage: a lost executor costs the tasks it held, not the stages before.
    """
    path = work_folder(rows.sparkSession, name)
    rows.write.options(**options).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def with_others_aside(
    docs: DataFrame, own: Sequence[str], operate: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """`operate` on the columns in `own`, with all others in one struct beside them.

    So no column of the input can be taken for one that the operator makes. What comes out has the
    columns of `docs` in their order, then those that were added; an added one takes the place of an input
    column of its name.
    """
    others = [name for name in docs.columns if name not in own]
    aside = F.struct(*[F.col(f"`{name}`") for name in others]) if others else F.lit(0)
    rows = operate(docs.select(*own, aside.alias("_others")))
    added = [name for name in rows.columns if name not in (*own, "_others")]
    kept = [name for name in docs.columns if name not in added]
    return rows.select(
        *[F.col(name) if name in own else F.col("_others").getField(name).alias(name) for name in kept],
        *added,
    )


def whole_text(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def split_words(text: Column, between: str = SPACE) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(text, between), "")


def content_key(text: Column) -> list[Column]:
    """128 bits that stand for a text: two hashes, equal texts only have equal ones."""
    return [F.xxhash64(text).alias("_key1"), F.xxhash64(F.lit(1), text).alias("_key2")]


KEY = ["_key1", "_key2"]


def sealed(value: Column) -> Column:
    """A struct as column `_sealed`, through a generator, which no filter is pushed below.

    Without it a filter on a result gets a copy of the whole expression of every step before.
    """
    return F.explode(F.array(value)).alias("_sealed")


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, shared by the tasks it runs."""
    import sys
    import types

    held = sys.modules.setdefault("_tapeline_cache", types.ModuleType("_tapeline_cache"))
    return held.__dict__.setdefault(name, {})


def text_slices(texts: list, most: int = 1_000_000):
    """Bounds of runs of texts that together have about `most` characters; a long text is whole."""
    first = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= most:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def hashed_sample(rows: DataFrame, key: Column, most: int, total: int) -> DataFrame:
    """At most `most` rows, those with the smallest hashes of a key, of a table of `total` rows.

    Tasks hold back rows whose hash is beyond what is needed, so what they pass on does not grow with
    their number. Rows of equal keys count in `total` but are passed on together.
    """
    share = min(1.0, 2 * most / max(total, 1))
    hashed = rows.withColumn("_hash", F.xxhash64(key, F.lit(17)))
    near = hashed.where(F.col("_hash") / F.lit(2.0**64) + 0.5 <= share)
    return near.dropDuplicates(["_hash"]).orderBy("_hash").limit(most).drop("_hash")
