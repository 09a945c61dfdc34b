"""Jaccard join against all pairs."""

import random
from itertools import combinations

import pytest
from llm_helpers import frame, odd_documents, rows_of, words

from tapeline.llm import jaccard
from tapeline.llm.components import connected
from tapeline.llm.jaccard import (
    labelled_rows, least_overlap, near_duplicate_groups, one_of_each_group, pairs_across, subset_sizes,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=3):
    w = words((text or "").translate(LOWER))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def plain_groups(rows, percent=90):
    sets = [shingles(t) for _, t, *_ in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
        if sets[i] and sets[j] and (100 * both >= percent * len(sets[i] | sets[j]) or same_id):
            group[root(i)] = root(j)
    smallest = {}
    for i, row in enumerate(rows):
        if sets[i] and row[0] is not None:
            smallest[root(i)] = min(smallest.get(root(i), row[0]), row[0])
    return sorted(
        ((r[0], len(s), smallest.get(root(i)) if s else r[0])
         for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=repr,
    )


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def near_copies(seed, base_words, copies, most_edits, shared=""):
    rng = random.Random(seed)
    base = " ".join(f"b{rng.randrange(5000)}" for _ in range(base_words))
    texts = [edited(rng, base, rng.randint(0, most_edits)) for _ in range(copies)]
    return [f"{t} {shared}".strip() for t in texts]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_equal_all_pairs(spark, seed):
    """Chains of edits without their base, short and long texts, a passage that many share."""
    rng = random.Random(seed)
    passage = " ".join(f"s{i}" for i in range(60))
    texts = []
    for size, copies, edits in ((150, 40, 5), (80, 30, 3), (24, 30, 2), (15, 40, 1), (10, 40, 1), (4, 10, 1)):
        texts += near_copies(rng.random(), size, copies, edits)
    for i in range(40):
        texts.append(passage + " " + " ".join(f"u{seed}{i}x{j}" for j in range(rng.randint(1, 40))))
    # A chain: each link close to the next, the ends far apart.
    chain = [f"c{i}" for i in range(120)]
    for i in range(20):
        texts.append(" ".join(chain))
        chain[3 * i : 3 * i + 2] = [f"d{i}", f"d{i}x"]
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)]
    got = rows_of(near_duplicate_groups(frame(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert got == plain_groups(rows)


def test_odd_rows(spark):
    rows = [r[:2] for r in odd_documents()] + [
        (40, "TWO words"), (41, "two"), (42, "one two three"), (43, "x" * 50_000),
        (None, "only here and without an id"), (None, "Only here and without an id"),
    ]
    docs = frame(spark, rows, clashing=True)
    got = rows_of(near_duplicate_groups(docs), "doc_id", "n_shingles", "component_id")
    assert got == plain_groups(rows)
    assert near_duplicate_groups(docs.limit(0)).collect() == []


def test_one_of_each_group(spark):
    rows = [r[:2] for r in odd_documents()]
    docs = frame(spark, rows, clashing=True)
    kept = one_of_each_group(docs)
    assert kept.schema == docs.schema
    found = sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id IS NOT NULL").collect() if r["text"])
    groups = {}
    for doc_id, n, component in plain_groups(rows):
        if n and doc_id is not None:
            groups.setdefault(component, doc_id)
            groups[component] = min(groups[component], doc_id)
    assert sorted(d for d, t in found if words(t)) == sorted(groups.values())
    assert kept.where("doc_id IN (1, 2, 3) OR (doc_id IS NULL AND text IS NULL)").count() == 4


def few_words(seed, count, length=60):
    """Texts of six words in any order, so that shingles are in many texts and hardly any two link."""
    rng = random.Random(seed)
    return [" ".join(rng.choice("abcdef") for _ in range(length)) for _ in range(count)]


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_split_lists_and_hubs(spark, monkeypatch, percent):
    """Long lists are split, hubs and blocks are dealt to several tasks, and no link is lost."""
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "SPLIT_COST", 4)
    rng = random.Random(percent)
    texts = few_words(1, 120) + [edited(rng, t, 1) for t in few_words(1, 120)[::4]]
    texts += few_words(2, 60, 4) + few_words(3, 60, 9) + near_copies(4, 100, 40, 3) + ["a b c"] * 3
    rows = list(enumerate(texts))
    got = near_duplicate_groups(frame(spark, rows), percent=percent)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == plain_groups(rows, percent)


def test_lists_without_links_form_few_pairs(spark, monkeypatch):
    """Splitting forms a part of the pairs that lie in lists, a smaller one the longer the lists are."""
    monkeypatch.setattr(jaccard, "SPLIT_COST", 4)
    shares = []
    for count in (400, 1600):
        formed = {}

        def say(name, table, formed=formed):
            if name == "open":
                sizes = [r["count"] for r in table.groupBy("token").count().collect()]
                formed["plain"] = sum(n * (n - 1) for n in sizes)
            if name == "lists":
                formed["split"] = formed.get("split", 0) + sum(r["pairs"] for r in table.collect())

        labelled_rows(frame(spark, list(enumerate(few_words(5, count)))), say=say)
        shares.append(formed["split"] / formed["plain"])
    assert shares[0] < 0.8 and shares[1] < 0.6 * shares[0]


def test_one_outsider_meets_a_list_once(spark):
    """A list of one component and one other member makes as many pairs as the component has members."""
    open_lists = spark.createDataFrame(
        [(1, i, 0, 100, 0) for i in range(500)] + [(1, 900, 0, 100, 900)],
        "token bigint, node bigint, pos int, n bigint, label bigint",
    )
    classes = open_lists.selectExpr("node", "array(token) AS prefix")
    costs = []

    def say(name, table):
        costs.extend((r["size"], r["outside"]) for r in table.collect())

    pairs = rows_of(pairs_across(open_lists, classes, 90, say), "a", "b")
    assert costs == [(501, 1)] and pairs == sorted(((i, 900) for i in range(500)), key=repr)


def test_least_overlap():
    for a in range(1, 40):
        for b in range(1, 40):
            c = least_overlap(a, b)
            assert 100 * c >= 90 * (a + b - c) and 100 * (c - 1) < 90 * (a + b - c + 1)
    assert (18, 20, 18) in subset_sizes(18, 20, 90)


def test_connected(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 60)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    frame_ = spark.createDataFrame([(b, a) for a, b in edges], "a bigint, b bigint")
    group = {}
    for a, b in edges:
        ga, gb = group.get(a, {a}), group.get(b, {b})
        both = ga | gb
        for x in both:
            group[x] = both
    expected = sorted((x, min(g)) for x, g in group.items() if len(g) > 1)
    assert rows_of(connected(frame_), "node", "label") == sorted(expected, key=repr)
    assert connected(frame_.limit(0)).collect() == []
