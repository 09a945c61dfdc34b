"""The quality classifier against plain readings of its features, its fit and its score."""

import math
import random
import zlib

import numpy as np
import pytest
from llm_helpers import frame, odd_documents

from tapeline.llm import classifier as c
from tapeline.llm.classifier import fit, fit_from_labels, ngrams, quality_scores, score_documents, score_texts

LABELS = "doc_id bigint, quality bigint, toxic bigint"
SF_DIR = "/root/testdata/sf0.1"


def plain_bucket(parts):
    mixed = len(parts)
    for part, mix in zip(parts, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9), strict=False):
        mixed = (mixed ^ part) * mix % 2**64
        mixed ^= mixed >> 29
    return mixed % 2**c.FEATURE_BITS


def plain_features(text):
    """Buckets of a text, one n-gram at a time."""
    tokens = c._TOKENS.findall(text)
    words = [zlib.crc32(t.encode()) for t in tokens]
    kinds = [zlib.crc32(b"k:" + c.token_kind(t).encode()) for t in tokens]
    kinds = [k + (i > 0 and words[i] == words[i - 1]) for i, k in enumerate(kinds)]
    runs = [(words, 1), (words, 2), (kinds, 1), (kinds, 2), (kinds, 3)]
    return [plain_bucket(x[i : i + n]) for x, n in runs for i in range(len(x) - n + 1)]


def plain_fit(rows, importance):
    """The leader over rows (features, label), one weight at a time."""
    z, n, bias_z, bias_n = {}, {}, 0.0, 0.0

    def weight(f):
        if abs(z.get(f, 0.0)) <= c.L1:
            return 0.0
        return -(z[f] - math.copysign(c.L1, z[f])) / ((c.BETA + n[f] ** 0.5) / c.ALPHA + c.L2)

    def bias():
        return -bias_z / ((c.BETA + bias_n**0.5) / c.ALPHA)

    for features, y in rows:
        values = {f: features.count(f) * c.SCALE / max(len(features), 1) for f in set(features)}
        old = {f: weight(f) for f in values}
        b = bias()
        p = 1 / (1 + math.exp(-(b + sum(old[f] * v for f, v in values.items()))))
        error = importance[y] * (p - y)
        for f, v in values.items():
            g, before = error * v, n.get(f, 0.0)
            n[f] = before + g * g
            z[f] = z.get(f, 0.0) + g - (n[f] ** 0.5 - before**0.5) / c.ALPHA * old[f]
        bias_z += error - ((bias_n + error**2) ** 0.5 - bias_n**0.5) / c.ALPHA * b
        bias_n += error**2
    return {f: weight(f) for f in n}, bias()


def sentence(rng, good):
    words = [rng.choice(["sun", "Moon", "étoile", "x1", "rain", "sea"]) for _ in range(rng.randint(1, 30))]
    return " ".join(w if good else w.upper() + "!!" for w in words)


def test_features_one_at_a_time():
    texts = ["", " ", "one", "Two two TWO", "a a a b!! ## ### x_1 22 Ünder", "x" * 9_000, "é" * 3 + "\n\n🙂🙂"]
    buckets, doc = ngrams(texts, {})
    for i, text in enumerate(texts):
        assert sorted(buckets[doc == i].tolist()) == sorted(plain_features(text))


def test_fit_and_score_against_plain_arithmetic():
    rng = random.Random(3)
    labels = [rng.random() < 0.7 for _ in range(60)]
    texts = [sentence(rng, y) for y in labels]
    share, rate = sum(labels) / 60, 0.9
    importance = ((1 - rate) / (1 - share), rate / share)
    rows = [(plain_features(t), int(y)) for t, y in zip(texts, labels, strict=True)]
    weights, bias = fit(texts, labels, rate, rounds=2)
    expected, expected_bias = plain_fit(rows * 2, importance)
    assert bias == pytest.approx(expected_bias)
    assert {int(f) for f in np.flatnonzero(weights)} == {f for f, w in expected.items() if w}
    for f, w in expected.items():
        assert weights[f] == pytest.approx(w)
    for text, score in zip(texts, score_texts(texts, weights, bias, {}), strict=True):
        own = plain_features(text)
        total = bias + c.SCALE * sum(expected.get(f, 0.0) for f in own) / len(own)
        assert score == pytest.approx(1 / (1 + math.exp(-total)))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r for r in rows if r["quality"] == y] for y in (1, 0))
    assert len(bad) > 50
    assert sum(r["predicted"] for r in good) >= 0.99 * len(good)
    assert sum(r["predicted"] for r in bad) <= 0.03 * len(bad)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def labelled(spark, n=120):
    rng = random.Random(5)
    rows = [(i, sentence(rng, i % 3 > 0)) for i in range(n)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(n)]
    return rows, labels


def test_held_out_labels_do_not_matter(spark):
    rows, labels = labelled(spark)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    assert turned != labels
    models = [fit_from_labels(frame(spark, rows), spark.createDataFrame(x, LABELS)) for x in (labels, turned)]
    assert np.array_equal(models[0][0], models[1][0]) and models[0][1] == models[1][1]


def test_odd_rows_and_labels(spark):
    rows, labels = labelled(spark)
    odd = [(i and i + 1_000, *rest) for i, *rest in odd_documents()]
    labels += [(None, 1, 0), (1_001, None, None), (1_002, 7, 0), (0, 0, 0), (0, 1, 1), (99_999, 1, 0)]
    rows += odd + [(0, "another text of document 0"), (0, None)]
    docs = frame(spark, rows, clashing=True).withColumnRenamed("n", "_label").withColumnRenamed("a", "quality")
    table = spark.createDataFrame(labels, LABELS).withColumnRenamed("toxic", "score")
    got = quality_scores(docs, table)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    first = sorted(map(tuple, got.collect()), key=repr)
    assert len(first) == len(rows)
    again = quality_scores(docs.repartition(5), table.repartition(3))
    assert first == sorted(map(tuple, again.collect()), key=repr)
    blank = {s for i, _, s, _ in first if i in (1_001, 1_002, 1_003)}
    assert len(blank) == 1


def test_extra_columns_stay(spark):
    docs = frame(spark, [(1, "a b"), (2, None)], clashing=True)
    scored = score_documents(docs, *fit([], [], 0.5), score="own")
    assert scored.columns == [*docs.columns, "own"]
    assert sorted((r["doc_id"], r["score"], r["own"]) for r in scored.collect()) == [(1, "x", 0.5), (2, "x", 0.5)]


def test_without_rows_or_labels(spark):
    docs, none = frame(spark, [(1, "some text"), (2, "")]), spark.createDataFrame([], LABELS)
    assert {r["score"] for r in quality_scores(docs, none).collect()} == {0.5}
    assert quality_scores(docs.limit(0), none).collect() == []
    only = spark.createDataFrame([(i, 1, 0) for i in range(50)], LABELS)
    assert all(r["predicted"] == 1 for r in quality_scores(docs, only).collect())
