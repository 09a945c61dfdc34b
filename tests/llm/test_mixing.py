"""Mixing against the iterative reading of its targets."""

import math
import random
from collections import defaultdict

import pytest
from llm_helpers import frame, odd_documents, rows_of, words
from pyspark.sql import functions as F

from tapeline.llm.mixing import (
    RUN,
    document_sizes,
    golden_point,
    mix_pieces,
    mix_shares,
    mixed_documents,
    schedule,
    source_strings,
    source_targets,
)


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total = 1.5 * sum(sizes.values())
    target, rest = {}, set(order)
    while rest:
        left = total - sum(target.values())
        unit = left / sum(weight[s] for s in rest)
        over = [s for s in rest if unit * weight[s] > 2 * sizes[s]]
        if not over:
            target |= {s: unit * weight[s] for s in rest}
            break
        target |= {s: 2 * sizes[s] for s in over}
        rest -= set(over)
    return target


def random_rows(seed, sources=7, docs=150):
    rng = random.Random(seed)
    return [
        (i, "w " * int(rng.paretovariate(0.7)), rng.choice(["big", *map(str, range(sources)), None]))
        for i in range(docs)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken(spark, seed):
    rows = [(i, t[:40_000], s) for i, t, s in random_rows(seed)]
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(words(text))
    target = plain_targets(sizes)
    shares = mix_shares(frame(spark, rows)).collect()
    assert len(shares) == len(rows)
    taken = defaultdict(int)
    for r in shares:
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        taken[r["source"]] += r["taken"]
    for source in sizes:
        assert taken[source] == pytest.approx(target[source], abs=1)


def test_reruns_agree(spark):
    docs = frame(spark, random_rows(3))
    columns = ("doc_id", "taken")
    again = docs.repartition(5)
    assert rows_of(mix_shares(docs), *columns) == rows_of(mix_shares(again), *columns)


def test_slots_follow_weights_all_along(spark):
    rows = [(i, "w " * 300, str(i % 4)) for i in range(400)]
    sizes = document_sizes(frame(spark, rows))
    targets = source_targets(sizes).collect()
    total = sum(r["target"] for r in targets)
    slots = schedule(source_targets(sizes), 16).orderBy("slot").collect()
    for upto in (500, 2000, 5000):
        for r in targets:
            n = sum(s["source_no"] == r["source_no"] for s in slots[:upto])
            assert abs(n - upto * r["target"] / total) < 12


def test_golden_points_keep_their_fraction(spark):
    numbers = [0, 1, 2, 3, 4_095, 65_536, 2**32 - 1, 2**32, 2**32 + 1, 40_000_000_001, 2**52 + 5, 2**61 + 12_345]
    rows = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    got = {r["n"]: r["p"] for r in rows.select("n", golden_point(F.col("n")).alias("p")).collect()}
    for n in numbers:
        assert got[n] == pytest.approx(n * 0x9E3779B97F4A7C15 % 2**64 / 2**64, abs=2e-16)
    near = spark.range(40_000_000_000, 40_000_100_000).select(golden_point(F.col("id")).alias("p"))
    assert near.distinct().count() == 100_000


def plain_mix(shares, block):
    """Slot by slot: taken, first and last slot and number of pieces of every document."""
    target = {s["source"]: s["target"] for s in shares}
    order = sorted(target, key=lambda s: (s is None, s or ""))
    total = sum(target.values())
    strings = {s: [] for s in order}
    for r in sorted(shares, key=lambda r: (r["shuffle"], r["doc_id"], r["size"])):
        strings[r["source"]].append((r["doc_id"], r["size"]))
    words_of = {
        s: [d for d, size in docs for _ in range(size)] * 2 for s, docs in strings.items()
    }
    for s in order:
        words_of[s] = words_of[s][: math.floor(target[s] + 0.5)]
    done, found, n_slots = dict.fromkeys(order, 0), {}, -int(-total // block)

    def fill(slot, source):
        begin = done[source] * block
        some = words_of[source][begin : begin + block]
        done[source] += 1
        for doc in dict.fromkeys(some):
            found.setdefault(doc, []).append((slot, some.count(doc)))

    for slot in range(n_slots):
        point, upto = slot * 0x9E3779B97F4A7C15 % 2**64 / 2**64, 0.0
        for source in order:
            upto += target[source] / total
            if point < upto:
                fill(slot, source)
                break
    got = dict(done)
    for i, source in enumerate(order):
        while done[source] * block < len(words_of[source]):
            fill(n_slots + (done[source] - got[source]) * len(order) + i, source)
    return {
        doc: (sum(n for _, n in pieces), min(pieces)[0], max(pieces)[0]) for doc, pieces in found.items()
    }


@pytest.mark.parametrize("seed", [6, 7])
def test_shares_and_slots_against_a_plain_reading(spark, seed):
    rows = [(i, t[:6_000], s) for i, t, s in random_rows(seed, sources=4, docs=120)]
    shares = mix_shares(frame(spark, rows), block=16).collect()
    expected = plain_mix(shares, 16)
    got = {r["doc_id"]: (r["taken"], r["first_slot"], r["last_slot"]) for r in shares if r["taken"]}
    assert got == expected
    assert all(r["first_slot"] is None and r["n_slots"] == 0 for r in shares if not r["taken"])


def test_mixed_documents_stand_in_the_order_of_their_slots(spark):
    docs = frame(spark, [(i, "w " * 400, str(i % 4)) for i in range(900)])
    slots = {r["doc_id"]: (r["first_slot"], r["last_slot"]) for r in mix_shares(docs).collect()}
    parts = mixed_documents(docs).select("doc_id", F.spark_partition_id().alias("part")).collect()
    for part in {r["part"] for r in parts}:
        seen, place = set(), []
        for r in parts:
            if r["part"] == part:
                place.append(slots[r["doc_id"]][r["doc_id"] in seen])
                seen.add(r["doc_id"])
        runs = [p // RUN for p in place]
        assert all(a <= b for a, b in zip(place, place[1:], strict=False) if a // RUN == b // RUN)
        assert len(set(runs)) == 1 + sum(a != b for a, b in zip(runs, runs[1:], strict=False))


def test_pieces_fill_blocks(spark):
    sizes = document_sizes(frame(spark, random_rows(4)))
    targets = source_targets(sizes)
    pieces = mix_pieces(source_strings(sizes, targets), targets, 16).collect()
    filled = defaultdict(int)
    for p in pieces:
        filled[p["slot"]] += p["words"]
        assert 0 <= p["from_word"] and p["from_word"] + p["words"] <= p["size"]
    short = [n for n in filled.values() if n != 16]
    assert max(filled.values()) == 16 and len(short) <= 9


def test_mixed_documents(spark):
    docs = frame(spark, random_rows(5), clashing=True)
    mixed = mixed_documents(docs)
    assert mixed.schema == docs.schema
    taken = dict(rows_of(mix_shares(docs), "doc_id", "taken"))
    got = defaultdict(int)
    for r in mixed.collect():
        got[r["doc_id"]] += len(words(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert got == {d: n for d, n in taken.items() if n}


def test_odd_rows(spark):
    docs = frame(spark, odd_documents(), clashing=True)
    shares = mix_shares(docs)
    assert shares.count() == docs.count()
    assert shares.where("size = 0 AND taken <> 0").count() == 0
    assert mixed_documents(docs).schema == docs.schema
    assert mix_shares(docs.limit(0)).collect() == []
    assert mixed_documents(docs.limit(0)).collect() == []
    assert mix_shares(frame(spark, [(1, None), (2, "")])).agg({"taken": "sum"}).first()[0] == 0
