"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots of `BLOCK` words. Slot n gets the source at the point frac(n * phi) of
the cumulative target weights, phi being the golden ratio: any run of slots holds every source close
to its weight. The documents of a source, shuffled by a hash, are one string of words that is gone
through again after its end, cut into blocks of equal size; the k-th slot of a source takes its k-th
block. The schedule misses a source's share by a few slots: slots beyond the target are not filled,
and what is missing is put after the last slot, so every source gives its target to the word.

Nothing is ordered in one task but the table of sources, which has a row per source. Running totals
over documents and ranks over slots are made in levels: inside chunks of some hundred rows, then over
the chunks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import split_words, stored, whole_text, with_others_aside

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 512
CHUNK = 256
# Slots that are kept together in a mix that is written out.
RUN = 4_096

# Fractional part of the golden ratio in 64 binary places, as two halves.
_GOLDEN_HIGH, _GOLDEN_LOW = 0x9E3779B9, 0x7F4A7C15


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """Per source: `source`, `source_no`, `n_docs`, `source_size`, `target` (words).

    Sources by code point, null last, get `weights` in turn, and `share` of all sizes is dealt out
    by weight. No target exceeds `most` times its source's size: what is too much is dealt out again
    among the rest. That ends at one level for all sources below their limit; a source is at its
    limit if the level reaches limit / weight, so one pass in the order of that ratio finds it.
    """
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    every = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        sources.withColumn("source_no", place)
        .withColumn("weight", F.get(turn, F.col("source_no") % len(weights)))
        .withColumn("limit", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
    )
    at_limit = Window.orderBy("ratio", "source_no").rowsBetween(Window.unboundedPreceding, -1)

    def rest(value: Column) -> Column:
        return -F.coalesce(F.sum(value).over(at_limit), F.lit(0.0))

    level = (F.sum("source_size").over(every) * share + rest(F.col("limit"))) / (
        F.sum("weight").over(every) + rest(F.col("weight"))
    )
    # Levels fall from the first source on that stays below its limit, so the largest is its own.
    held = F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(every)
    return ranked.withColumn("level", level).select(
        "source",
        "source_no",
        "n_docs",
        "source_size",
        F.least("limit", F.coalesce(F.col("weight") * held, "limit")).alias("target"),
    )


def _sum_before(value: str, by: list[str], order: list[str]) -> Column:
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0).cast("bigint"))


def _chunk_starts(rows: DataFrame, value: Column) -> DataFrame:
    """Sum of `value` over all earlier chunks of a source: `source_no`, `chunk`, `_start`."""
    fine = rows.groupBy("source_no", "chunk").agg(F.sum(value).alias("n"))
    fine = fine.withColumn("_run", F.floor(F.col("chunk") / CHUNK))
    runs = fine.groupBy("source_no", "_run").agg(F.sum("n").alias("n"))
    before = _sum_before("n", ["source_no"], ["_run"])
    runs = runs.select("source_no", "_run", before.alias("_before"))
    inside = _sum_before("n", ["source_no", "_run"], ["chunk"])
    return (
        fine.withColumn("_inside", inside)
        .join(runs, ["source_no", "_run"])
        .select("source_no", "chunk", (F.col("_inside") + F.col("_before")).alias("_start"))
    )


def document_sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """`doc_id`, `source`, `size` in words (null text: 0) and the hash that shuffles documents."""
    return docs.select(
        "doc_id",
        "source",
        F.size(split_words(whole_text(text))).cast("bigint").alias("size"),
        F.xxhash64("doc_id", text).alias("shuffle"),
    )


def source_strings(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents with `begin`, the words of their source before them, and their source's numbers.

    Within a source documents come in the order of their hash. The chunk is taken from the hash as
    well, so chunks are in order too, and hold about `CHUNK` documents each whatever the source.
    Equal rows stand next to each other, in any order.
    """
    named = targets.withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    chunks = F.ceil(F.col("n_docs") / CHUNK)
    point = F.col("shuffle") / F.lit(2.0**64) + 0.5
    rows = (
        sizes.join(named, same)
        .drop("_source")
        .withColumn("chunk", F.least(F.floor(point * chunks), chunks - 1))
    )
    inside = _sum_before("size", ["source_no", "chunk"], ["shuffle", "doc_id", "size"])
    return (
        rows.withColumn("_inside", inside)
        .join(_chunk_starts(rows, F.col("size")), ["source_no", "chunk"])
        .withColumn("begin", F.col("_start") + F.col("_inside"))
        .drop("chunk", "_inside", "_start", "n_docs")
    )


def golden_point(n: Column) -> Column:
    """frac(n * golden ratio), exact to the last of 53 places for any n below 2^62.

    The product modulo 2^64 is put together from halves, as n times a double would lose its fraction.
    """
    half = 1 << 32
    n_high, n_low = F.shiftright(n, 32), n.bitwiseAND(half - 1)
    a, b = F.shiftright(n_low, 16), n_low.bitwiseAND(0xFFFF)
    low = b * _GOLDEN_LOW + (a * _GOLDEN_LOW).bitwiseAND(0xFFFF) * (1 << 16)
    carried = F.shiftright(low, 32) + F.shiftright(a * _GOLDEN_LOW, 16)
    high = (
        carried
        + b * _GOLDEN_HIGH
        + (a * _GOLDEN_HIGH).bitwiseAND(0xFFFF) * (1 << 16)
        + n_high * _GOLDEN_LOW
    ).bitwiseAND(half - 1)
    return (high + low.bitwiseAND(half - 1) / half) / half


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """The slots: `slot`, `source_no`, `block_no`, of which a source has as many as it needs.

    A point finds its source through cells of equal width, which every source's span is cut into: a
    heavy source has many cells, and a cell about `CHUNK` slots.
    """
    spark = targets.sparkSession
    total, n_sources = targets.agg(
        F.coalesce(F.sum("target"), F.lit(0.0)), F.count(F.lit(1))
    ).first()
    slots = int(-(-total // block))
    cells = max(1, 4 * n_sources, slots // CHUNK)
    to = F.sum("target").over(
        Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    )
    spans = targets.withColumn("hi", to / F.lit(total or 1.0)).withColumn(
        "lo", F.col("hi") - F.col("target") / F.lit(total or 1.0)
    )
    last = F.lit(cells - 1)
    cut = spans.select(
        "source_no",
        "lo",
        "hi",
        F.explode(
            F.sequence(
                F.least(F.floor(F.col("lo") * cells), last),
                F.least(F.floor(F.col("hi") * cells), last),
            )
        ).alias("cell"),
    )
    points = spark.range(slots).select(F.col("id").alias("slot"), golden_point(F.col("id")).alias("point"))
    hit = (
        points.withColumn("cell", F.floor(F.col("point") * cells))
        .join(cut, "cell")
        .where((F.col("point") >= F.col("lo")) & (F.col("point") < F.col("hi")))
        .select("slot", "source_no", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    )
    rank = F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot")) - 1
    ranked = (
        hit.withColumn("_rank", rank)
        .join(_chunk_starts(hit, F.lit(1)), ["source_no", "chunk"])
        .select("slot", "source_no", (F.col("_start") + F.col("_rank")).alias("block_no"))
    )
    needs = targets.select(
        "source_no", F.ceil(F.round("target") / block).cast("bigint").alias("needed")
    )
    filled = ranked.join(needs, "source_no").where("block_no < needed").drop("needed")
    # What the schedule fell short of, a few blocks for each source, comes after its end.
    got = ranked.groupBy("source_no").agg(F.count(F.lit(1)).alias("got"))
    short = needs.join(got, "source_no", "left").na.fill(0, ["got"]).where("got < needed")
    tail = short.select(
        "source_no", "got", F.explode(F.expr("sequence(got, needed - 1)")).alias("block_no")
    )
    turn = (F.col("block_no") - F.col("got")) * n_sources + F.col("source_no")
    tail = tail.select((slots + turn).alias("slot"), "source_no", "block_no")
    return filled.unionByName(tail)


def mix_pieces(strings: DataFrame, targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix: for every slot the pieces of documents in it.

    Columns: slot, source_no, begin, size (these three name the document), round (0, or 1 when the
    source is gone through again), from_word, words.
    """
    rounds = strings.where("size > 0").select(
        "source_no",
        "begin",
        "size",
        F.round("target").cast("bigint").alias("_target"),
        F.posexplode(F.expr("array(begin, begin + source_size)")).alias("round", "_first"),
    )
    taken = rounds.withColumn("_last", F.least(F.expr("_first + size"), F.col("_target"))).where(
        "_first < _last"
    )
    pieces = taken.withColumn(
        "block_no", F.explode(F.expr(f"sequence(_first div {block}, (_last - 1) div {block})"))
    )
    start = F.greatest(F.col("_first"), F.col("block_no") * block)
    stop = F.least(F.col("_last"), (F.col("block_no") + 1) * block)
    return pieces.join(schedule(targets, block), ["source_no", "block_no"]).select(
        "slot",
        "source_no",
        "begin",
        "size",
        "round",
        (start - F.col("_first")).alias("from_word"),
        (stop - start).alias("words"),
    )


def mix_shares(docs: DataFrame, text: str = "text", block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, shuffle, source, size, source_size, target, taken, first_slot, last_slot, n_slots.

    `taken` counts the words that the mix takes of the document, repeats counted, from 0 to
    `MOST` times its size, in `n_slots` pieces, of which the first and last stand in the slots named (null
    if nothing is taken). Empty and null texts have size 0 and nothing is taken of them; null
    sources are a source of their own; rows that are equal are each a document of their own; an
    empty table gives no rows; other columns are not read.
    """
    sizes = stored(document_sizes(docs, text), "mix-sizes")
    targets = stored(source_targets(sizes), "mix-targets")
    strings = stored(source_strings(sizes, targets), "mix-strings")
    key = ["source_no", "begin", "size"]
    taken = mix_pieces(strings, targets, block).groupBy(*key).agg(
        F.sum("words").alias("taken"),
        F.min("slot").alias("first_slot"),
        F.max("slot").alias("last_slot"),
        F.count(F.lit(1)).alias("n_slots"),
    )
    return strings.join(taken, key, "left").select(
        "doc_id",
        "shuffle",
        "source",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"),
        "first_slot",
        "last_slot",
        F.coalesce("n_slots", F.lit(0).cast("bigint")).alias("n_slots"),
    )


def mixed_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents as the mix takes them, with the columns of `docs`, in runs of slots.

    A document is repeated as often as it is taken whole; what is taken of it beyond that is a row
    with the first words of its text. Documents of which nothing is taken are left out, among them
    those without words. Rows that are equal take what they take together in equal parts. Each
    partition holds runs of `RUN` slots in the order of the schedule, a document where its first piece stands, a
    repeat where its last does: read one run after another, the sources come by their weights all along.
    """
    own = [name for name in ("doc_id", text, "source", "n_chars") if name in docs.columns]
    return with_others_aside(docs, own, lambda rows: _mixed(rows, text))


def _mixed(docs: DataFrame, text: str) -> DataFrame:
    shares = mix_shares(docs, text)
    keys = [F.col(name).alias(f"_{name}") for name in ("doc_id", "shuffle", "source")]
    shares = shares.groupBy(*keys).agg(
        F.max("size").alias("_size"),
        F.avg("taken").cast("bigint").alias("_taken"),
        F.min("first_slot").alias("_first_slot"),
        F.max("last_slot").alias("_last_slot"),
    )
    keyed = docs.withColumn("_own", F.xxhash64("doc_id", text))
    same = [
        F.col("_own") == F.col("_shuffle"),
        F.col("doc_id").eqNullSafe(F.col("_doc_id")),
        F.col("source").eqNullSafe(F.col("_source")),
    ]
    copies = """transform(sequence(1, CAST(ceil(_taken / _size) AS INT)), i -> struct(
                    least(_size, _taken - (i - 1) * _size) AS words,
                    if(i = 1, _first_slot, _last_slot) AS slot))"""
    rows = (
        keyed.join(shares.where("_taken > 0"), reduce(lambda a, b: a & b, same))
        .select("*", F.explode(F.expr(copies)).alias("_copy"))
        .withColumn("_words", F.col("_copy.words"))
        .withColumn("_slot", F.col("_copy.slot"))
        .withColumn("_run", F.floor(F.col("_slot") / RUN))
        .repartition("_run")
        .sortWithinPartitions("_run", "_slot", "doc_id", "_words")
    )
    whole = F.col("_words") == F.col("_size")
    first_words = F.array_join(
        F.slice(
            F.split(F.col(text), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"),
            F.lit(1),
            F.col("_words").cast("int"),
        ),
        "",
    )
    changed = {text: F.when(whole, F.col(text)).otherwise(first_words)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(whole, F.col("n_chars")).otherwise(
            F.length(first_words).cast(dict(docs.dtypes)["n_chars"])
        )
    return rows.withColumns(changed).select(*docs.columns)
