"""Spelling variants: words one edit apart, and the frequent word that each goes back to.

The vocabulary is a trie kept as a distributed table of edges (node, label, child). States (word,
position, node, edits) walk it level by level, a join with the edge table per level, until none is
left; a state with one edit that ends at the end of a word is a pair of neighbours.

Of a pair one edit apart, the edit lies in the second half of the words or, read backwards, in the
second half of the reversed words. So there are two tries, of the words and of their reverses, and a
state without an edit stands at its own prefix, from the middle of its word on: no join is needed to
bring it there, and no edits are tried near the root, where nodes have many children. Nodes with one way on and
no word's end are left out, their labels joined to one, so an edge can be many code points long. A state
is only made if its label fits whole and the node behind it has an edge for the code point that comes
next.

Nodes are known by 64 bits of their prefix; equal ones only add states, as pairs are joined back to the
vocabulary by the words themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import stored, whole_text

SHORTEST = 6
LEAST = 5
# A form is at least so many times as frequent as the word.
RATIO = 5
# One run in so many loses a code point.
SLIPS = 199

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """`word`, `n`: words of at least `shortest` code points that occur at least `least` times.

    Runs of letters, A-Z lower-cased; where `SLIPS` divides h, the crc32 of `<doc_id>:<run>`, the run's
    code point h % length is left out. Null texts have no runs, a null doc_id reads as empty.
    """
    # Runs that are too short stay so: nothing makes a word longer.
    text = F.translate(whole_text(), UPPER, LOWER)
    found = F.regexp_extract_all(text, F.lit(f"[a-zÀ-ÿ]{{{shortest},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(h % SLIPS == 0, shorter).otherwise(F.col("run"))
    counted = runs.groupBy(word.alias("word")).agg(F.count(F.lit(1)).alias("n"))
    # As one condition on the count, which is not pushed below it: there it would hash every run again.
    return counted.where(F.when(F.col("n") >= least, F.length("word")) >= shortest)


def _bit(char: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(char), F.lit(64)).cast("int"))


def _from(text: Column | str, at: Column, many: Column) -> Column:
    return F.substring(text, at + 1, many)


def word_paths(words: DataFrame) -> DataFrame:
    """Each word, forwards and reversed: `text`, `n`, `side`, and its `stops` in the trie, from the root on.

    A stop is a node where paths part or a word ends: depth, node, whether paths part, whether a word
    ends, and the first code points of its edges as a mask. Only depths that a word one edit away may
    come from are in the trie.
    """
    length = F.length("text")
    sides = [
        words.select("word_no", F.lit(side).alias("side"), text.alias("text"), "n")
        for side, text in ((0, F.col("word")), (1, F.reverse("word")))
    ]
    texts = sides[0].unionByName(sides[1])
    first = F.when(F.col("side") == 0, F.floor((length - 1) / 2)).otherwise(F.ceil(length / 2))
    # Hashes are made here, so that a long word is not copied for each of its prefixes.
    places = F.transform(
        F.sequence(first.cast("int"), length),
        lambda d: F.struct(
            d.alias("depth"),
            F.xxhash64("side", F.substring("text", F.lit(1), d)).alias("node"),
            _from("text", d, F.lit(1)).alias("next"),
        ),
    )
    prefixes = texts.select("word_no", "side", F.explode(places).alias("at")).select("word_no", "side", "at.*")
    ways = F.when(F.col("next") != "", _bit(F.col("next"))).otherwise(0)
    nodes = (
        prefixes.groupBy("node")
        .agg(F.min("next").alias("low"), F.max("next").alias("high"), F.bit_or(ways).alias("ways"))
        .where("low = '' OR low <> high")
        .select("node", (F.col("low") != F.col("high")).alias("parts"), (F.col("low") == "").alias("ends"), "ways")
    )
    stop = F.struct("depth", "node", "parts", "ends", "ways")
    stops = (
        prefixes.join(nodes, "node")
        .groupBy("word_no", "side")
        .agg(F.sort_array(F.collect_list(stop)).alias("stops"))
    )
    return texts.join(stops, ["word_no", "side"]).drop("word_no")


def edge_table(paths: DataFrame) -> DataFrame:
    """`node`, `first`, `label`, and of the child: `child`, `ends`, `ways`. One row per edge of both tries."""
    steps = F.transform(
        F.slice("stops", F.lit(1), F.size("stops") - 1),
        lambda s, i: F.struct(s.alias("up"), F.get("stops", i + 1).alias("down")),
    )
    label = _from("text", F.col("s.up.depth"), F.col("s.down.depth") - F.col("s.up.depth"))
    found = paths.select(F.explode(steps).alias("s"), "text").select(
        F.col("s.up.node").alias("node"),
        label.alias("label"),
        F.col("s.down.node").alias("child"),
        F.col("s.down.ends").alias("ends"),
        F.col("s.down.ways").alias("ways"),
    )
    return found.distinct().withColumn("first", F.substring("label", 1, 1))


def first_states(paths: DataFrame) -> DataFrame:
    """States without an edit: a text at each node, from its middle on, where paths part."""
    length, depth = F.length("text"), F.col("s.depth")
    half = F.floor(length / 2)
    # Backwards, what lies in the first half of the word.
    begin = F.when(F.col("side") == 0, half).otherwise(length - half)
    inserts = (F.col("side") == 0) | (depth > begin)
    return paths.select("text", "n", "side", F.explode("stops").alias("s")).where(
        F.col("s.parts") & (depth >= begin)
    ).select("text", "n", "side", depth.alias("position"), F.col("s.node").alias("node"), inserts.alias("inserts"))


def _fits(states: DataFrame) -> DataFrame:
    """States that have gone along an edge: those whose target agrees with it and can go on or end."""
    arrived = F.col("position") + F.length("label")
    next_char = _from("target", arrived, F.lit(1))
    here = F.length("target") == arrived
    return (
        states.where(_from("target", F.col("position"), F.length("label")) == F.col("label"))
        .where(F.when(here, F.col("ends")).otherwise(F.col("ways").bitwiseAND(_bit(next_char)) != 0))
        .select(
            "text", "n", "side", "target",
            arrived.alias("position"), F.col("child").alias("node"), F.lit(1).alias("edits"), here.alias("done"),
        )
    )


def _edited(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States without an edit, after an edit at their position: a code point replaced or put in.

    Of two words that differ in one code point the one with the smaller one is edited, of two lengths
    the shorter; where a code point is put into a run of equal ones, behind it.
    """
    own = _from("text", F.col("position"), F.lit(1))
    head = F.substring("text", F.lit(1), F.col("position"))
    tail = _from("text", F.col("position"), F.length("text"))
    replaced = F.when((own != "") & (own < F.col("first")), F.concat(head, "first", F.substring(tail, F.lit(2), F.length("text"))))
    put_in = F.when(F.col("inserts"), F.concat(head, "first", tail))
    targets = F.array_compact(F.array(replaced, put_in))
    met = states.join(edges, "node").where(own != F.col("first"))
    return _fits(met.select("*", F.explode(targets).alias("target")))


def near_pairs(words: DataFrame) -> DataFrame:
    """`word`, `near`, `near_n` for all words exactly one edit apart, both ways. `words`: word, n, distinct."""
    numbered = stored(words.withColumn("word_no", F.monotonically_increasing_id()), "spelling-words")
    paths = stored(word_paths(numbered), "spelling-paths")
    edges = stored(edge_table(paths), "spelling-edges")
    states = stored(_edited(first_states(paths), edges), "spelling-states")
    done = [states.where("done")]
    # A round for each stop on the way from an edit to the end of a word.
    while not (going := states.where("NOT done")).isEmpty():
        first = _from("target", F.col("position"), F.lit(1))
        states = stored(_fits(going.withColumn("first", first).join(edges, ["node", "first"])), "spelling-states")
        done.append(states.where("done"))
    found = reduce(DataFrame.unionByName, done)

    def ahead(text: str) -> Column:
        return F.when(F.col("side") == 0, F.col(text)).otherwise(F.reverse(text)).alias(text)

    pairs = found.select(ahead("text"), "n", ahead("target")).distinct()
    known = numbered.select(F.col("word").alias("target"), F.col("n").alias("target_n"))
    both = F.array(
        F.struct(F.col("text").alias("word"), F.col("target").alias("near"), F.col("target_n").alias("near_n")),
        F.struct(F.col("target").alias("word"), F.col("text").alias("near"), F.col("n").alias("near_n")),
    )
    return pairs.join(known, "target").select(F.inline(both))


def _roots(links: DataFrame) -> DataFrame:
    """`word`, `root` of the words that have a form: forms followed to the last, twice as far each round.

    A form is `RATIO` times as frequent as its word, so chains are short.
    """
    roots = stored(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("_root"))
        joined = stored(roots.join(further, "root", "left"), "spelling-roots")
        if joined.where("_root IS NOT NULL").isEmpty():
            return joined.select("word", "root")
        roots = joined.select("word", F.coalesce("_root", "root").alias("root"))


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Words (`word`, `n`, each once) with `form`, `root`, `n_near` and `form_n`.

    A word's form is its near word of largest n, ties the smallest by code point, if that is at least
    `ratio` times the word's n; the root is the last form of the forms followed from the word, itself if it has none.
    """
    words = stored(words, "spelling-vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    formed = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The variant groups of the vocabulary of `docs` (doc_id, text; other columns are not read).

    One row per word; repeated documents count as often as they stand there; without words no rows.
    """
    return variant_groups(vocabulary(docs.select("doc_id", "text")))
