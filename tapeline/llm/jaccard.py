"""N-gram Jaccard join, size-aware: subsets for small sets, inverted lists for large ones.

A document's set is its distinct word shingles. Two sets of sizes a and b are linked if their overlap
is at least c(a, b), the least integer for which the Jaccard threshold holds.

* Light sets enumerate all their subsets of c(lo, hi) shingles for every pair of sizes that can link.
  Two sets of such sizes with a subset in common are linked, so nothing is left to verify.
* Heavy sets put the first shingles of a global order (rarest first) into inverted lists. Linked sets
  share one of them. How large a set may be to count as light is found by cost: rows that its subsets
  make against rows and comparisons that its lists make.

Documents with equal sets form a class and are joined as one. Links are looked for until everything
that could be linked is known to be in one component or compared: first every member of a list with
the list's pivot, its member with the fewest rarer shingles; then, only in lists whose members are
still in several components, members of different components with one another. So a group of
thousands of near copies costs about as many comparisons as it has members, and no link is lost.
A list in which that would be many pairs is split by the next shingle that its members share, and
its parts again, as long as the parts cost less than the list: linked sets share not one but many of
their first shingles. Candidates pass a length filter and a filter on 512 parity bits (a bound on the
symmetric difference) before their whole sets are compared. A node that stands in many pairs is
joined to them in several tasks.

The order of shingles is by a count of 2**20 hashed buckets over the whole corpus, then by hash: any
total order gives the same links, a good one gives short lists. Its size does not depend on the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import stored, with_others_aside, worker_cache
from tapeline.llm.components import connected
from tapeline.streaming.runs import session_settings

SHINGLE = 3
BUCKET_BITS = 20
CHUNK_BITS = 14
PARITY_WORDS = 8
LIGHT_MOST = 24
# What one comparison of two sets costs, in rows shuffled.
COMPARE_COST = 10
# How many shared shingles a list is split by at most; more only cost time.
DEPTH = 6
# What a row of a part, which is written, costs in pairs, which are only formed and mostly filtered out.
SPLIT_COST = 64
# Rows of a list, or pairs of a node, that one task joins at a time.
BLOCK = 1000
REMEMBERED = 250_000
# Rows that Spark and a Python worker hand each other at a time.
BATCH_ROWS = 500

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xD6E8FEB86659FD93)


def least_overlap(a: int, b: int, percent: int = 90) -> int:
    """Smallest overlap of sets of a and b elements with percent * union <= 100 * overlap."""
    return -(-percent * (a + b) // (100 + percent))


def _overlap_column(a: Column, b: Column, percent: int) -> Column:
    return F.ceil(F.lit(percent) * (a + b) / F.lit(100 + percent) - 1e-9)


def _least_partner_overlap(percent: int) -> Column:
    """What a set of `n` elements shares at least with any that it is linked to."""
    return F.expr(f"({percent} * n + 99) div 100")


def _lead(percent: int) -> Column:
    """How many of its rarest shingles a set puts into lists."""
    return (F.col("n") - _least_partner_overlap(percent) + 1).cast("int")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD2
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _word_hashes() -> _WordHashes:
    held = worker_cache("word_hashes")
    if len(held.get("words", ())) > REMEMBERED:
        held.clear()
    return held.setdefault("words", _WordHashes())


def shingle_hashes(text: bytes | None, n: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the shingles of a text, in order, repeated ones included.

    Fewer words than `n` are one shingle, no words are none. A to Z count as lower case; words lie
    between the six ASCII space characters, which is what splitting bytes goes by.
    """
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, len(words))
    width = min(n, len(ids))
    last = len(ids) - width + 1
    h = np.full(last, width, np.uint64)
    for j in range(width):
        h = _mix(h * _ODD + ids[j : j + last])
    return h


def bucket_counts(docs: DataFrame, text: str, n: int) -> np.ndarray:
    """How many shingles of the corpus fall into each hash bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            texts = batch.column(0)
            for first in range(0, len(texts), 100):
                some = [shingle_hashes(t, n) for t in texts.slice(first, 100).to_pylist()]
                bucket = np.concatenate(some) >> np.uint64(64 - BUCKET_BITS)
                seen += np.bincount(bucket.astype(np.int64), minlength=len(seen))
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int32)), pa.array(seen[found])], ["bucket", "n"]
        )

    rows = docs.select(F.col(text).cast("binary")).mapInArrow(count, "bucket int, n bigint")
    summed = rows.groupBy("bucket").agg(F.sum("n").alias("n"))

    def pack(buckets: pa.Table) -> pa.Table:
        at = buckets.column("bucket").to_numpy()
        counts = np.zeros(1 << CHUNK_BITS, np.int64)
        counts[at & ((1 << CHUNK_BITS) - 1)] = buckets.column("n").to_numpy()
        return pa.table(
            {
                "chunk": pa.array([int(at[0]) >> CHUNK_BITS], pa.int32()),
                "counts": pa.array([counts.tobytes()], pa.binary()),
            }
        )

    # As bytes, a fixed number of rows of a fixed size, so that the driver holds little else.
    chunks = summed.withColumn("chunk", F.shiftright("bucket", CHUNK_BITS)).groupBy("chunk")
    table = np.zeros((1 << (BUCKET_BITS - CHUNK_BITS), 1 << CHUNK_BITS), np.int64)
    for row in chunks.applyInArrow(pack, "chunk int, counts binary").collect():
        table[row["chunk"]] = np.frombuffer(row["counts"], np.int64)
    return table.ravel()


_SETS = (
    "doc_id bigint, text_hash bigint, n bigint, class binary, parity array<bigint>,"
    " prefix array<bigint>, shingles array<bigint>"
)


def document_sets(docs: DataFrame, id_column: str, text: str, n: int, percent: int) -> DataFrame:
    """Per document: size and class of its set, parity bits, and its rarest shingles.

    `prefix` has one shingle more than a linked set may lack, and `DEPTH` - 1 more to split lists by;
    `shingles` has all of a small set.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bucket_counts(docs, text, n))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        counts = sent.value
        for batch in batches:
            sizes, classes, parities, prefixes, small = [], [], [], [], []
            for raw in batch.column(2).to_pylist():
                h = np.unique(shingle_hashes(raw, n))
                bits = np.bincount((h & np.uint64(511)).astype(np.int64), minlength=512) & 1
                lead = len(h) - -(-percent * len(h) // 100) + DEPTH if len(h) else 0
                order = np.lexsort((h, counts[(h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]))
                signed = h.view(np.int64)
                sizes.append(len(h))
                classes.append(xxhash.xxh3_128_digest(h.tobytes()))
                parities.append(np.packbits(bits).view(np.int64))
                prefixes.append(signed[order[:lead]])
                small.append(signed if len(h) <= LIGHT_MOST else signed[:0])
            columns = [
                batch.column(0).cast(pa.int64()),
                batch.column(1),
                pa.array(sizes, pa.int64()),
                pa.array(classes, pa.binary()),
                *[pa.array(x, pa.list_(pa.int64())) for x in (parities, prefixes, small)],
            ]
            names = ["doc_id", "text_hash", "n", "class", "parity", "prefix", "shingles"]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(text), F.col(text).cast("binary")
    )
    return rows.mapInArrow(sets, _SETS)


def _known_id(id_column: str) -> Column:
    return F.coalesce(F.col(id_column).cast("bigint"), F.lit(0).cast("bigint"))


def subset_sizes(size: int, most: int, percent: int) -> list[tuple[int, int, int]]:
    """(lo, hi, c): pairs of sizes up to `most`, this one among them, that can link, and c(lo, hi)."""
    found = []
    for other in range(1, most + 1):
        lo, hi = min(size, other), max(size, other)
        if least_overlap(lo, hi, percent) <= lo:
            found.append((lo, hi, least_overlap(lo, hi, percent)))
    return found


def light_links(classes: DataFrame, most: int, percent: int) -> DataFrame:
    """Links between sets of up to `most` elements, as (a, b), by the subsets they share."""

    def subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            keys, nodes, sizes, low = [], [], [], []
            for node, shingles in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for lo, hi, c in subset_sizes(len(shingles), most, percent):
                    for some in combinations(shingles, c):
                        raw = np.array((lo, hi, *some), np.int64).tobytes()
                        keys.append(xxhash.xxh3_128_digest(raw))
                        nodes.append(node)
                        sizes.append(len(shingles))
                        low.append(lo)
            columns = [
                pa.array(keys, pa.binary()), pa.array(nodes, pa.int64()),
                pa.array(sizes, pa.int64()), pa.array(low, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "node", "n", "lo"])

    light = classes.where((F.col("n") > 0) & (F.col("n") <= most)).select("node", "shingles")
    rows = stored(
        light.mapInArrow(subsets, "key binary, node bigint, n bigint, lo bigint"), "subsets"
    )
    # Every set with the subset links to a smallest one; two larger ones need not link.
    pivots = rows.where("n = lo").groupBy("key").agg(F.min("node").alias("pivot"))
    return rows.join(pivots, "key").where("node <> pivot").select(
        F.col("pivot").alias("a"), F.col("node").alias("b")
    )


def light_most(classes: DataFrame, percent: int) -> int:
    """Largest size whose subsets cost less than its lists.

    The mean length of the lists that small sets are in is measured on the whole index.
    """
    lists = (
        classes.where(F.col("n").between(1, LIGHT_MOST))
        .select(F.explode(F.slice("prefix", F.lit(1), _lead(percent))).alias("token"))
        .groupBy("token")
        .count()
        .agg(F.avg("count"))
        .first()[0]
    )
    most = 0
    for size in range(1, LIGHT_MOST + 1):
        subsets = 0
        for lo, hi, c in subset_sizes(size, 100 * size // percent, percent):
            ways = 1
            for i in range(size - c):
                ways = ways * (size - i) // (i + 1)
            subsets += ways if lo <= size <= hi else 0
        lead = size - -(-percent * size // 100) + 1
        if subsets <= lead * (1 + COMPARE_COST * (lists or 1.0)):
            most = size
    return most


class _Links:
    """Candidates to links: filters, then whole sets."""

    def __init__(self, texts: DataFrame, classes: DataFrame, n: int, percent: int):
        self.texts, self.classes, self.n, self.percent = texts, classes, n, percent

    def likely(self, pairs: DataFrame, hubs: DataFrame) -> DataFrame:
        """Pairs (a, b) that pass the filters on length and parity, with `d`, the parity distance."""
        for side in ("a", "b"):
            named = [F.col(c).alias(f"{c}_{side}") for c in ("n", "parity")]
            pairs = _beside(pairs, side, self.classes.select("node", *named), hubs)
        a, b = F.col("n_a"), F.col("n_b")
        overlap = _overlap_column(a, b, self.percent)
        distance = sum(
            (
                F.bit_count(F.get("parity_a", F.lit(i)).bitwiseXOR(F.get("parity_b", F.lit(i))))
                for i in range(PARITY_WORDS)
            ),
            F.lit(0),
        )
        return (
            pairs.where(overlap <= F.least(a, b))
            .withColumn("d", distance)
            .where(F.col("d") <= a + b - 2 * overlap)
            .select("a", "b", "d")
        )

    def sets_of(self, pairs: DataFrame, hint: str | None = None) -> DataFrame:
        """Whole sets of the classes that stand in the pairs, from the text of one document each."""
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        n = self.n

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [np.unique(shingle_hashes(t, n)).tobytes() for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(found, pa.binary())], ["node", "set"]
                )

        # Stored, so that its size is known before the texts would be shuffled for it. Equal rows have
        # the same id and text, so one of them is enough.
        wanted = self.classes.join(nodes, "node").select("node", "_id", "_hash")
        wanted = stored(wanted, "wanted")
        wanted = wanted.hint(hint) if hint else wanted
        texts = self.texts.join(wanted, ["_id", "_hash"]).dropDuplicates(["_id", "_hash"])
        return texts.select("node", "text").mapInArrow(whole, "node bigint, set binary")

    def verified(self, pairs: DataFrame, sets: DataFrame, hubs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose whole sets meet the threshold."""
        percent = self.percent

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held = []
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    held.append(100 * both >= percent * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(held, pa.bool_()))

        joined = pairs.select("a", "b")
        for side in ("a", "b"):
            joined = _beside(joined, side, sets.select("node", F.col("set").alias(f"set_{side}")), hubs)
        return joined.select("a", "b", "set_a", "set_b").mapInArrow(compare, "a bigint, b bigint")


def _hubs(ends: DataFrame) -> DataFrame:
    """`hub` and `parts` of the nodes that stand in more than `BLOCK` of the rows (node)."""
    parts = F.ceil(F.col("count") / F.lit(BLOCK)).cast("int").alias("parts")
    counted = ends.groupBy("node").count().where(F.col("count") > BLOCK)
    return stored(counted.select(F.col("node").alias("hub"), parts), "hubs")


def _beside(
    pairs: DataFrame, side: str, info: DataFrame, hubs: DataFrame, how: str = "inner"
) -> DataFrame:
    """Pairs with what `info` has for the node of one side.

    A hub's pairs are dealt by their other side to `parts` tasks, each of which gets its row of `info`.
    """
    other = "b" if side == "a" else "a"
    parts = F.coalesce("parts", F.lit(1))
    dealt = (
        pairs.join(hubs, F.col(side) == F.col("hub"), "left")
        .withColumn("_part", F.pmod(F.xxhash64(other), parts).cast("int"))
        .drop("hub", "parts")
    )
    spread = (
        info.join(hubs, F.col("node") == F.col("hub"), "left")
        .withColumn("_each", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("hub", "parts")
    )
    both = (F.col(side) == F.col("node")) & (F.col("_part") == F.col("_each"))
    return dealt.join(spread, both, how).drop("node", "_part", "_each")


def _apart(pairs: DataFrame, labels: DataFrame, hubs: DataFrame) -> DataFrame:
    """Pairs whose sides are not known to be in one component."""
    for side in ("a", "b"):
        named = labels.select("node", F.col("label").alias(f"_label_{side}"))
        pairs = _beside(pairs, side, named, hubs, "left")
    a, b = (F.coalesce(f"_label_{s}", F.col(s)) for s in ("a", "b"))
    return pairs.where(a != b).drop("_label_a", "_label_b")


def _list_costs(entries: DataFrame, *more: str) -> DataFrame:
    """Per list (key) with several components: members, largest component, pairs, rows of its parts.

    Members outside the largest component meet all others, so there are at most twice as many pairs
    as lie across components.
    """
    by_label = entries.groupBy("key", *more, "label").agg(
        F.count(F.lit(1)).alias("size"), F.sum("room").alias("room")
    )
    lists = by_label.groupBy("key", *more).agg(
        F.sum("size").alias("size"),
        F.max(F.struct("size", "label")).alias("main"),
        F.sum("room").alias("room"),
    )
    outside = (F.col("size") - F.col("main.size")).alias("outside")
    return lists.select(
        "key", *more, "size", outside, F.col("main.label").alias("main"), "room",
        (F.col("size") * outside.cast("double")).alias("pairs"),
    ).where("outside > 0")


def _list_parts(entries: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Entries of lists, `parent`, once for each next shingle that a linked set can share.

    If sets share at least c elements, the first k that they share are among the first n - c + k of
    each, for any k up to c. Sets too small for that are kept as a part of their own, which ends.
    """
    deeper = (
        entries.where("room > 0")
        .join(classes.select("node", "prefix"), "node")
        .select(
            F.col("key").alias("parent"), "node", "label", "n", "known", F.col("pos").alias("_last"),
            F.posexplode(F.slice("prefix", F.col("pos") + 2, F.col("room"))).alias("_at", "_token"),
        )
        .select(
            "parent", F.xxhash64("parent", "_token").alias("key"), "node", "label", "n",
            (F.col("_last") + 1 + F.col("_at")).alias("pos"), (F.col("known") + 1).alias("known"),
        )
        .withColumn("room", _room(percent))
    )
    ended = entries.where(_least_partner_overlap(percent) <= F.col("known")).select(
        F.col("key").alias("parent"), F.xxhash64("key", F.lit("ended")).alias("key"),
        "node", "label", "n", "pos", "known", F.lit(0).alias("room"),
    )
    return deeper.unionByName(ended)


def _room(percent: int) -> Column:
    """How many shingles after `pos` can be the next that a linked set shares."""
    last = F.least(_lead(percent) + F.col("known") - 1, F.col("n") - 1)
    return F.greatest(last - F.col("pos"), F.lit(0)).cast("int")


def _list_pairs(entries: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) across the components of each list that pass the filters on length and position.

    Members outside the largest component meet all others, in blocks of about `BLOCK` by `BLOCK` rows.
    """
    rows = entries.join(lists.select("key", "size", "outside", "main"), "key")
    across, down = (F.ceil(F.col(c) / F.lit(BLOCK)).cast("int") for c in ("outside", "size"))

    def side(of: DataFrame, name: str, row: Column, column: Column) -> DataFrame:
        kept = [F.col(c).alias(f"{c}_{name}") for c in ("node", "pos", "n", "label", "known", "main")]
        return of.select("key", row.alias("_row"), column.alias("_column"), *kept)

    def every(blocks: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), blocks - 1))

    def dealt(blocks: Column) -> Column:
        return F.pmod(F.xxhash64("node"), blocks).cast("int")

    left = side(rows.where("label <> main"), "a", dealt(across), every(down))
    right = side(rows, "b", every(across), dealt(down))
    a, b = F.col("n_a"), F.col("n_b")
    shared = F.least(a - F.col("pos_a"), b - F.col("pos_b")) + F.col("known_a") - 1
    return (
        left.join(right, ["key", "_row", "_column"])
        .where("label_a <> label_b AND (label_b = main_b OR node_a < node_b)")
        .where(_overlap_column(a, b, percent) <= F.least(shared, a, b))
        .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    )


def pairs_across(
    open_lists: DataFrame,
    classes: DataFrame,
    percent: int,
    say: Callable[[str, DataFrame], None] = lambda name, rows: None,
) -> DataFrame:
    """Distinct pairs (a, b) of members of one list in different components that can be linked.

    A list is split by next shared shingles where its pairs cost more than the rows of its parts, and stays
    split where the parts together have fewer pairs than the whole. The first split may have up to twice
    as many: two shared shingles often gain nothing where three do.
    """
    entries = open_lists.select(
        F.col("token").alias("key"), "node", "label", "n", "pos", F.lit(1).alias("known")
    )
    entries = entries.withColumn("room", _room(percent))
    found = []
    for depth in range(1, DEPTH + 1):
        lists = stored(_list_costs(entries), "lists-open")
        long = lists.where(F.col("pairs") > SPLIT_COST * F.col("room")).where("room > 0")
        if depth == DEPTH or long.isEmpty():
            say("lists", lists)
            found.append(_list_pairs(entries, lists, percent))
            break
        parts = stored(
            _list_parts(entries.join(long.select("key"), "key", "left_semi"), classes, percent), "parts"
        )
        costs = stored(_list_costs(parts, "parent"), "part-costs")
        summed = costs.groupBy(F.col("parent").alias("key")).agg(F.sum("pairs").alias("_parts"))
        split = stored(
            long.join(summed, "key", "left")
            .where(F.expr("coalesce(_parts, 0) + room") < F.col("pairs") * (2 if depth == 1 else 1))
            .select("key"),
            "split",
        )
        whole = lists.join(split, "key", "left_anti")
        say("lists", whole)
        found.append(_list_pairs(entries, whole, percent))
        kept = costs.join(split.withColumnRenamed("key", "parent"), "parent", "left_semi")
        entries = parts.join(kept.select("key", "parent"), ["key", "parent"], "left_semi").drop("parent")
        entries = stored(entries, "entries")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def labelled_rows(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    n: int = SHINGLE,
    percent: int = 90,
    say: Callable[[str, DataFrame], None] = lambda name, rows: None,
) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, `label` of its component, and its smallest id.

    Rows without words have a null label. `say` is told the tables of each step.
    """
    # Rows here hold whole texts or whole sets; all work on them is done before this returns.
    with session_settings(docs.sparkSession, {_BATCH_ROWS: str(BATCH_ROWS)}):
        return _labelled_rows(docs, id_column, text, n, percent, say)


def _labelled_rows(
    docs: DataFrame,
    id_column: str,
    text: str,
    n: int,
    percent: int,
    say: Callable[[str, DataFrame], None],
) -> DataFrame:
    rows = stored(document_sets(docs, id_column, text, n, percent), "sets")
    # A class is named by its smallest id; one that has none, by its hash.
    classes = stored(
        rows.where("n > 0")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("first_id"),
            *[F.first(c).alias(c) for c in ("n", "parity", "prefix", "shingles")],
            F.first(_known_id("doc_id")).alias("_id"),
            F.first("text_hash").alias("_hash"),
        )
        .withColumn("node", F.coalesce("first_id", F.xxhash64("class"))),
        "classes",
    )
    most = light_most(classes, percent)
    light = light_links(classes, most, percent)

    # Sets that can link to a heavy one are in the lists as well.
    least = -(-percent * (most + 1) // 100)
    index = classes.where(F.col("n") >= least).select(
        "node", F.posexplode(F.slice("prefix", F.lit(1), _lead(percent))).alias("pos", "token")
    )
    texts = docs.select(
        _known_id(id_column).alias("_id"),
        F.xxhash64(text).alias("_hash"),
        F.col(text).cast("binary").alias("text"),
    )
    links = _Links(texts, classes, n, percent)

    pivots = (
        index.groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"), F.min_by("node", "pos").alias("a"))
        .where("n > 1")
        .drop("n")
    )
    # Most shingles are in one list entry only; what is left is a small part of the index.
    lists = stored(index.join(pivots, "token"), "lists")
    hubs = _hubs(lists.select(F.col("a").alias("node")))
    pairs = lists.where("node <> a").select("a", F.col("node").alias("b")).distinct()
    likely = stored(links.likely(pairs, hubs), "likely")
    say("likely", likely)
    # Near copies are a share of all documents, so they are joined alike at every size; what is left
    # to compare across components is not, and is joined as its size allows.
    sets = stored(links.sets_of(likely, "merge"), "whole-sets")
    nearest = likely.groupBy("b").agg(F.min_by("a", "d").alias("a"))
    found = stored(light.unionByName(links.verified(nearest, sets, hubs)), "linked")
    labels = stored(connected(found), "labels")
    more = links.verified(_apart(likely, labels, hubs), sets, hubs)
    found = stored(found.unionByName(more), "linked")
    labels = stored(connected(found), "labels")
    say("linked", found)

    # Lists with members in several components: pairs across components.
    in_lists = lists.drop("a").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = (
        in_lists.groupBy("token")
        .agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"))
        .where("_lo < _hi")
        .select("token")
    )
    sizes = classes.select("node", "n")
    open_lists = stored(in_lists.join(mixed, "token").join(sizes, "node"), "open-lists")
    say("open", open_lists)
    pairs = stored(pairs_across(open_lists, classes, percent, say), "across")
    hubs = _hubs(pairs.select(F.explode(F.array("a", "b")).alias("node")))
    likely = stored(links.likely(pairs, hubs), "likely")
    say("likely across", likely)
    more = links.verified(likely, stored(links.sets_of(likely), "whole-sets"), hubs)
    labels = stored(connected(found.unionByName(more)), "labels")

    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = named.select("class", "label").join(smallest, "label")
    return rows.select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), "class"
    ).join(named, "class", "left").drop("class")


def near_duplicate_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    n: int = SHINGLE,
    percent: int = 90,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id.

    The component is the smallest id reachable by links, the document's own included. Documents
    without words (or with a null text) have an empty set and are linked with nothing. Equal texts
    are linked. A document without an id links others but has no name: its component is the smallest
    id among them, or null. Rows that share an id count as one document in the components. Other
    columns are not read, and an empty table gives no rows.
    """
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    rows = labelled_rows(docs, id_column, text, n, percent)
    return rows.select("doc_id", "n_shingles", own.alias("component_id"))


def one_of_each_group(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    n: int = SHINGLE,
    percent: int = 90,
) -> DataFrame:
    """`docs` with one row of each group, the one with the smallest id. Columns stay as they are.

    Rows without words belong to no group and all stay. Rows without an id are last in their group;
    of equal rows one stays.
    """
    return with_others_aside(
        docs, [id_column, text], lambda rows: _one_of_each_group(rows, id_column, text, n, percent)
    )


def _one_of_each_group(docs: DataFrame, id_column: str, text: str, n: int, percent: int) -> DataFrame:
    def key(identity: Column, text_hash: Column) -> dict[str, Column]:
        last = F.lit(2**63 - 1)
        return {"_key1": F.coalesce(identity.cast("bigint"), last), "_key2": text_hash}

    chosen = (
        labelled_rows(docs, id_column, text, n, percent)
        .where("n_shingles > 0")
        .withColumns(key(F.col("doc_id"), F.col("text_hash")))
        .groupBy("label")
        .agg(F.min(F.struct("_key1", "_key2")).alias("_row"))
        .select("_row.*")
        .distinct()
    )
    has_words = F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = docs.where(has_words).withColumns(key(F.col(id_column), F.xxhash64(text)))
    kept = kept.join(chosen, ["_key1", "_key2"]).dropDuplicates(["_key1", "_key2"])
    return kept.select(*docs.columns).unionByName(docs.where(~has_words))
