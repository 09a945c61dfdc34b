"""Spelling variants against words compared with each other."""

import random
import re
import zlib
from collections import Counter

import pytest
from llm_helpers import frame, odd_documents

from tapeline.llm.spelling import LOWER, UPPER, near_pairs, spelling_variants, variant_groups, vocabulary

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_vocabulary(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in RUN.findall((text or "").translate(str.maketrans(UPPER, LOWER))):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 5 * counts[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def found(table):
    assert table.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in table.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def word_table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n bigint")


@pytest.mark.parametrize("seed", range(3))
def test_dense_words(spark, seed):
    # Few letters, so that most words have many neighbours and runs of equal letters.
    rng = random.Random(seed)
    letters = ["ab", "aéb", "abc"][seed]
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(6, 10))) for _ in range(400)}
    counts = {w: rng.choice([5, 6, 30, 200, 2_000]) for w in words}
    assert found(variant_groups(word_table(spark, counts))) == plain_groups(counts)


def test_runs_ends_and_nested_words(spark):
    words = ["a" * n for n in range(6, 40)] + ["b" + "a" * 8, "a" * 8 + "b", "aaaabaaaa", "zzzzzz", "zzzzzzz"]
    words += ["ÿ" + "a" * 7, "a" * 7 + "ÿ", "abcdefgh", "bcdefgh", "abcdefg", "abcefgh", "xbcdefgh", "abcdefgx"]
    counts = {w: 5 * 7 ** (i % 4) for i, w in enumerate(words)}
    assert found(variant_groups(word_table(spark, counts))) == plain_groups(counts)


def test_words_that_share_a_beginning_or_an_end(spark):
    # A third of all words go through one node, forwards or backwards.
    rng = random.Random(9)
    tails = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(700)]
    words = {"prefix" + t for t in tails} | {t + "suffix" for t in tails} | {t[::-1] + t for t in tails}
    counts = {w: rng.choice([5, 25, 125, 700]) for w in words}
    assert found(variant_groups(word_table(spark, counts))) == plain_groups(counts)


def test_very_long_words(spark):
    long = "".join(random.Random(1).choice("abcdefgh") for _ in range(4_000))
    counts = {long: 5, long[:-1] + "z": 25, "z" + long: 125, long[:2_000] + long[2_001:]: 7, long[::-1]: 5}
    assert found(variant_groups(word_table(spark, counts))) == plain_groups(counts)


def test_vocabulary_and_slips(spark):
    rng = random.Random(4)
    words = ["hÉllo", "Étoiles", "abcdefg", "ABCDEFG", "×÷×÷×÷×", "naïveté", "abcdef", "x" * 300]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", "1", "'", "-", "…"]) for _ in range(9))) for i in range(900)]
    rows += [(None, "abcdefg " * 400), (7, None), (8, "")] + odd_documents() * 2
    counts = {r["word"]: r["n"] for r in vocabulary(frame(spark, rows)).collect()}
    assert counts == plain_vocabulary(rows)
    assert "bcdefg" in counts or "abcdeg" in counts or "abcdef" in counts


def test_odd_documents_and_clashing_columns(spark):
    rows = odd_documents() * 6 + [(50 + i, "variant " * 9 + "varient " * 1) for i in range(9)]
    table = frame(spark, rows, clashing=True).withColumnRenamed("n", "word").withColumnRenamed("a", "run")
    assert found(spelling_variants(table)) == plain_groups(plain_vocabulary(rows))


def test_no_words(spark):
    assert found(spelling_variants(frame(spark, []))) == set()
    assert found(spelling_variants(frame(spark, [(1, None), (2, "too few words here")]))) == set()
    assert near_pairs(word_table(spark, {"lonely": 5})).collect() == []
