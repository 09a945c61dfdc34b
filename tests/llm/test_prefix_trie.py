"""The trie of conversations against one built prefix by prefix."""

import hashlib
import math
import random
import zlib

import pytest

from tapeline.llm.prefix_trie import conversation_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
EXTRA = ", a string, b string, block string, level string, depth string, key_a string, run string, path string"
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def plain_trie(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns, key=lambda x: x[:3])] for c, turns in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path, convs in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
            leaves[path[:d]] += path not in children
    return {
        (
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
            children.get(path, 0), leaves[path], saved[path],
            hashlib.sha256(
                ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(path)).encode()
            ).hexdigest(),
        )
        for path, convs in members.items()
    }


def found(spark, rows, width=8, clashing=False):
    if clashing:
        rows = [(*row, *["x"] * 8) for row in rows]
    table = spark.createDataFrame(rows, SCHEMA + (EXTRA if clashing else ""))
    trie = conversation_trie(table, width)
    assert trie.columns == COLUMNS
    got = [tuple(r) for r in trie.collect()]
    assert len(got) == len(set(got))
    return set(got)


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice("us"), rng.choice(["é", "yes", "no", ""]))
        for c in range(convs)
        for t in range(rng.choice([1, 2, 3, longest]))
    ]


@pytest.mark.parametrize("width", [3, 8])
def test_random_conversations(spark, width):
    rows = random_rows(width, 120, 20)
    assert found(spark, rows, width) == plain_trie(rows)


def test_one_node_holds_most_conversations(spark):
    rows = [(c, t, "user", "hello") for c in range(0, 6_000, 5) for t in range(2)]
    rows += [(c, t, "user", "hello") for c in range(1, 600, 5) for t in range(10)]
    assert found(spark, rows) == plain_trie(rows)


def test_long_conversations(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (10, 15, 20) for t in range(700)]
    rows += [(20, 9_000 + t, "user", "other") for t in range(600)]
    assert found(spark, rows, clashing=True) == plain_trie(rows)


def test_nulls_ties_repeats_and_turnless(spark):
    rows = [
        (None, 0, "user", "lost"), (0, None, "user", "first"), (0, 3, None, None), (0, 1, "user", None),
        (3, 0, "user", "first"), (3, 0, "user", "first"), (3, 0, "assistant", "first"),
        (-7, 2, "user", "x" * 100_000), (-7, None, None, "x" * 100_000),
        # h is 8 for 8 and 7 for 13: without 5 and 10 nothing is left of them.
        (8, 0, "user", "gone"), (13, 0, "user", "gone"), (2**62, -5, "a", "b"), (2**62, 5, "a", "b"),
    ]
    expected = plain_trie(rows)
    assert found(spark, rows) == expected
    assert found(spark, rows, clashing=True) == expected
    assert any(depth == 0 and n > 2 for _, depth, _, n, *_ in expected)


def test_role_and_text_are_kept_apart(spark):
    rows = [(0, 0, "a", "bc"), (20, 0, "ab", "c"), (40, 0, "1:a", "bc"), (60, 0, "", "abc")]
    assert found(spark, rows) == plain_trie(rows)


def test_no_conversations(spark):
    assert found(spark, []) == set()
    assert found(spark, [(None, 1, "a", "b")]) == set()
