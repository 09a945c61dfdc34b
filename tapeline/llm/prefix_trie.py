"""Prefix trie of conversations by ROLLUP over positional columns of turn ids.

A conversation is laid out in blocks of `WIDTH` columns, one turn id each. `GROUP BY block, prior node,
ROLLUP(t1, .., t8)` makes all prefixes of all blocks in one aggregation; `grouping_id()` tells a
group's depth. A block after the first is keyed by the node that the block before ends at. A node's
key is the exclusive or of the hashes of its (position, turn id) pairs, so the key of the prior node is
a running total, a parent's key is a node's own without its last pair, and long conversations need no
round of their own.

Sums over a subtree are sums over the members of its top, so they come from the same kind of
aggregation. A node belongs to its smallest member; on its own path that conversation owns every node
from some depth on. What is above, `shared` bytes, others own. With that,

    saved(v) = sum of shared over members - (members - 1) * bytes above v - shared of v's owner,

and the leaves below v are the members of v that own the childless node they end at.

Turn ids and keys have 128 bits; equal ones are taken for equal turns and nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import stored

WIDTH = 8
# Conversations of this many in a row share their first turns, fewer than `MOST_SHARED` of them.
FAMILY = 5
MOST_SHARED = 9
# Rows of one conversation that a running total takes at a time, and ids in a piece that is hashed.
RUN = 256
PIECE_BITS = 8

TURN = ["a", "b", "n_bytes"]
KEY = ["key_a", "key_b"]


def _pair_hash(position: Column, turn: Column, which: int) -> Column:
    """One of the two hashes of a turn at a position."""
    return F.xxhash64(F.lit(which), position, turn["a"], turn["b"])


def _starts(rows: DataFrame, by: str, run: str, **totals: Column) -> DataFrame:
    """Totals over all earlier runs of a group, for runs that have earlier ones."""
    sums = rows.groupBy(by, run).agg(*[c.alias(n) for n, c in totals.items()])
    before = Window.partitionBy(by).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    found = sums.select(
        by,
        run,
        F.count(F.lit(1)).over(before).alias("_earlier"),
        *[
            (F.bit_xor(n) if n.startswith("key") else F.sum(n)).over(before).alias(f"_{n}")
            for n in totals
        ],
    )
    return found.where("_earlier > 0").drop("_earlier")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `position` from 1, and of each turn its id (`a`, `b`) and bytes of text.

    Turns come in order of `turn`, null first, ties by role and then by text's hash. Null role and
    text are empty; rows without conv_id belong to no conversation and are left out. Positions are made
    in runs of `RUN` turn numbers and then over runs, so a very long conversation is not one task's.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    run = F.coalesce(F.floor(F.col("turn") / RUN), F.lit(-(2**62)))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.xxhash64(F.lit(1), whole).alias("a"),
        F.xxhash64(F.lit(2), whole).alias("b"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        run.alias("run"),
    )
    order = Window.partitionBy("conv_id", "run").orderBy("turn", "role", "a", "b")
    starts = _starts(rows, "conv_id", "run", n=F.count(F.lit(1)))
    position = F.row_number().over(order) + F.coalesce("_n", F.lit(0))
    return (
        rows.join(starts, ["conv_id", "run"], "left")
        .select("conv_id", position.alias("position"), *TURN)
    )


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation has from the first of its family."""
    return F.crc32(conv_id.cast("string")) % MOST_SHARED


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as they stand after the rebuild, and all conversations with their number of turns.

    Conversation c has the first h turns of c - c % 5 (all if there are fewer, none if there is no such
    conversation), then its own after its first h.
    """
    own = F.col("conv_id")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    named = sizes.select(
        "conv_id", "n", (own - own % FAMILY).alias("first"), shared_turns(own).alias("h")
    )
    firsts = sizes.select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    taken = F.least("h", F.coalesce("n_first", F.lit(0)))
    convs = (
        named.join(firsts, "first", "left")
        .withColumn("taken", taken)
        .withColumn("n_turns", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    )
    heads = (
        turns.where(F.col("position") < MOST_SHARED)
        .withColumnRenamed("conv_id", "first")
        .join(named.select("conv_id", "first", "h"), "first")
        .where("position <= h")
        .select("conv_id", "position", *TURN)
    )
    tails = (
        turns.where(F.col("position") > shared_turns(own))
        .join(convs.select("conv_id", (F.col("taken") - F.col("h")).alias("moved")), "conv_id")
        .select("conv_id", (F.col("position") + F.col("moved")).alias("position"), *TURN)
    )
    return heads.unionByName(tails), convs.select("conv_id", "n_turns")


def _path(width: int) -> Column:
    """The turns of a block, or of a node in it, in order."""
    slots = F.array(*[F.col(f"t{k}") for k in range(1, width + 1)])
    return F.filter(slots, lambda t: t.isNotNull())


def _folded(path: Column, block: Column, width: int, which: int) -> Column:
    hashes = F.transform(path, lambda t, i: _pair_hash(block * width + i, t, which))
    return F.aggregate(hashes, F.lit(0).cast("bigint"), lambda x, y: x.bitwiseXOR(y))


def _bytes(path: Column) -> Column:
    return F.aggregate(path, F.lit(0).cast("bigint"), lambda x, t: x + t["n_bytes"])


def turn_blocks(turns: DataFrame, convs: DataFrame, width: int = WIDTH) -> DataFrame:
    """A row per conversation and block: `t1`.., what the block adds, and the node before it.

    Every conversation has a block 0, without turns if it has none.
    """
    at = F.col("position") - 1
    none = [F.lit(None).cast("bigint").alias(c) for c in TURN]
    rows = turns.select(
        "conv_id", F.floor(at / width).alias("block"), (at % width + 1).alias("slot"), *TURN
    ).unionByName(
        convs.select("conv_id", F.lit(0).cast("bigint").alias("block"), F.lit(0).alias("slot"), *none)
    )
    held = [
        F.max(F.when(F.col("slot") == k, F.col(c))).alias(f"{c}{k}")
        for k in range(1, width + 1)
        for c in TURN
    ]
    slots = [
        F.when(F.col(f"a{k}").isNotNull(), F.struct(*[F.col(f"{c}{k}").alias(c) for c in TURN]))
        for k in range(1, width + 1)
    ]
    path = _path(width)
    blocks = (
        rows.groupBy("conv_id", "block")
        .agg(*held)
        .select("conv_id", "block", *[s.alias(f"t{k}") for k, s in enumerate(slots, 1)])
        .withColumn("key_a", _folded(path, F.col("block"), width, 1))
        .withColumn("key_b", _folded(path, F.col("block"), width, 2))
        .withColumn("n_bytes", _bytes(path))
        .withColumn("run", F.floor(F.col("block") / RUN))
    )
    totals = {"key_a": F.bit_xor("key_a"), "key_b": F.bit_xor("key_b"), "n_bytes": F.sum("n_bytes")}
    starts = _starts(blocks, "conv_id", "run", **totals)
    before = Window.partitionBy("conv_id", "run").orderBy("block")
    before = before.rowsBetween(Window.unboundedPreceding, -1)

    def prior(name: str, total: Column) -> Column:
        start, inside = (F.coalesce(c, F.lit(0).cast("bigint")) for c in (f"_{name}", total.over(before)))
        return start + inside if name == "n_bytes" else start.bitwiseXOR(inside)

    return blocks.join(starts, ["conv_id", "run"], "left").select(
        "conv_id",
        "block",
        *[f"t{k}" for k in range(1, width + 1)],
        *totals,
        *[prior(n, c).alias(f"prior_{n}") for n, c in totals.items()],
    )


def _prefixes(blocks: DataFrame, sums: str, width: int) -> DataFrame:
    """All nodes of all blocks, each once, with the given aggregates over their members."""
    columns = ", ".join(f"t{k}" for k in range(1, width + 1))
    path = _path(width)
    groups = blocks.sparkSession.sql(
        f"""
        SELECT block, prior_key_a, prior_key_b, prior_n_bytes, {columns},
               {width} - bit_count(grouping_id()) AS level,
               min(conv_id) AS conv_id, count(1) AS n_convs, {sums}
        FROM {{blocks}}
        GROUP BY block, prior_key_a, prior_key_b, prior_n_bytes, ROLLUP ({columns})
        """,
        blocks=blocks,
    )
    # The first level of a later block is the node that the block before ends at. A group in which
    # conversations have ended stands for a shorter prefix.
    return (
        groups.where((F.col("level") > 0) | (F.col("block") == 0))
        .withColumn("path", path)
        .where(F.size("path") == F.col("level"))
        .withColumn("depth", F.col("block") * width + F.col("level"))
        .withColumn("above", F.slice("path", 1, F.greatest(F.col("level") - 1, F.lit(0))))
        .withColumn("bytes_above", F.col("prior_n_bytes") + _bytes(F.col("above")))
    )


def _digests(convs: DataFrame) -> DataFrame:
    """`ends_sha256` per node (`depth` and key) that conversations end at, ids in ascending order.

    A digest is made by one task, as SHA-256 runs over its input in order; the ids of a node come to it
    in pieces that are put together before, and are never held at once.
    """
    node = ["depth", *KEY]
    pieces = convs.groupBy(*node, F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")))
        .alias("ids")
    )
    rows = pieces.repartition(*node).sortWithinPartitions(*node, "piece").select(*node, "ids")
    schema = pa.schema([("depth", pa.int64()), *[(k, pa.int64()) for k in KEY], ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = digest = None
        for batch in batches:
            done: list[tuple] = []
            for *at, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if at != current:
                    if current is not None:
                        done.append((*current, digest.hexdigest()))
                    current, digest = at, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)],
                    schema=schema,
                )
        if current is not None:
            last = [*current, digest.hexdigest()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], f.type) for x, f in zip(last, schema, strict=True)], schema=schema
            )

    return rows.mapInArrow(run, "depth bigint, key_a bigint, key_b bigint, ends_sha256 string")


def trie_of(turns: DataFrame, convs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The trie of conversations given by their turns, a row per node.

    `turns`: conv_id, position from 1 without gaps, a, b, n_bytes; `convs`: conv_id, n_turns, a row per
    conversation. Columns: conv_id (smallest member), depth, parent_conv_id (of the parent, null for
    the root), n_convs, n_children, n_leaves, saved_tokens (bytes of text that members need not store
    again below and at this node), ends_sha256. No conversations, no rows.
    """
    blocks = stored(turn_blocks(turns, convs, width), "trie-blocks")
    totals = blocks.groupBy("conv_id").agg(
        F.bit_xor("key_a").alias("key_a"),
        F.bit_xor("key_b").alias("key_b"),
        F.sum("n_bytes").alias("n_bytes"),
    )
    convs = stored(
        convs.join(totals, "conv_id").withColumnRenamed("n_turns", "depth"), "trie-conversations"
    )
    sized = blocks.join(convs.select("conv_id", "depth"), "conv_id")
    # What an owner owns begins at its first node; bytes above a node do not shrink along a path.
    owners = stored(
        _prefixes(sized, "max(depth) AS longest", width)
        .groupBy("conv_id")
        .agg(
            F.min("bytes_above").alias("shared"),
            F.max(F.when(F.col("longest") == F.col("depth"), 1).otherwise(0)).alias("leaf"),
        ),
        "trie-owners",
    )
    measures = convs.join(owners, "conv_id", "left").select(
        "conv_id",
        F.coalesce("shared", "n_bytes").alias("shared"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"),
    )
    sums = "sum(shared) AS shared, sum(leaf) AS n_leaves"
    found = _prefixes(blocks.join(measures, "conv_id"), sums, width)
    block = F.col("block")

    def key(path: str, prior: str, which: int) -> Column:
        return F.col(prior).bitwiseXOR(_folded(F.col(path), block, width, which))

    named = found.select(
        "conv_id", "depth", "n_convs", "n_leaves", "shared", "bytes_above",
        key("path", "prior_key_a", 1).alias("key_a"),
        key("path", "prior_key_b", 2).alias("key_b"),
        key("above", "prior_key_a", 1).alias("up_a"),
        key("above", "prior_key_b", 2).alias("up_b"),
    )
    own = owners.select("conv_id", F.col("shared").alias("own"))
    saved = F.col("shared") - (F.col("n_convs") - 1) * F.col("bytes_above") - F.col("own")
    nodes = stored(
        named.join(own, "conv_id").withColumn("saved_tokens", saved).drop("shared", "own", "bytes_above"),
        "trie-nodes",
    )
    node = ["depth", *KEY]
    up = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("key_a"), F.col("up_b").alias("key_b")]
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("key_a").alias("up_a"),
        F.col("key_b").alias("up_b"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(children, node, "left")
        .join(_digests(convs), node, "left")
        .join(above, ["depth", "up_a", "up_b"], "left")
        .select(
            "conv_id",
            F.col("depth").cast("bigint").alias("depth"),
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0).cast("bigint")).alias("n_children"),
            F.col("n_leaves").cast("bigint").alias("n_leaves"),
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """Trie of the rebuilt conversations of a table (conv_id, turn, role, text); see `trie_of`.

    Null role or text is empty, null turn comes first, ties stand in order of role and hash of the text,
    rows repeated are turns of their own, and rows without conv_id are left out. Other columns are not
    read.
    """
    # Read for positions, heads, tails and sizes.
    turns = stored(numbered_turns(conversations.select("conv_id", "turn", "role", "text")), "trie-turns")
    return trie_of(*rebuilt_turns(turns), width)
