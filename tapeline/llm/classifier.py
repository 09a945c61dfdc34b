"""Quality classifier: logistic regression over hashed word n-grams, fitted by follow the regularised leader.

Tokens are words and runs of other visible characters. Two streams of n-grams are hashed into the same
2^18 weights: the tokens themselves (one and two in a row), and their kinds (up to three in a row) -
case and length class of a word, first character and length of a symbol run, and whether a token is the
one before again - so that a model also knows writing it has not seen the words of. A feature's value
is its share of the document's n-grams, times `SCALE`; a score is the logistic function of a sparse dot
product, so documents of any length are alike.

The fit goes over a bounded sample of the labelled rows that may be used, `SAMPLE` of each label,
chosen by hash, in one task; rows count as much as their label is frequent among all usable rows. The
leader keeps per weight the sum of gradients and of their squares; weights whose sum stays below
`L1` are zero. Everything is scored, whole texts, by the tasks that read it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tapeline.llm.common import hashed_sample, text_slices, worker_cache

SAMPLE = {1: 3_000, 0: 1_500}
FEATURE_BITS = 18
SCALE = 20.0
ROUNDS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.1, 1.0
FOLDS = 5
THRESHOLD = 0.3
REMEMBERED = 400_000

_TOKENS = re.compile(r"\w+|[^\w\s]+")
_MASK = np.uint64((1 << FEATURE_BITS) - 1)
# Odd numbers that spread n-grams over the buckets; any would do.
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learned from: crc32 of its id modulo 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def token_kind(token: str) -> str:
    """Case and length class of a word; a run of symbols by its first character and length."""
    if not (token[0].isalnum() or token[0] == "_"):
        return f"{token[0]}{min(len(token), 4)}"
    if token.isdigit():
        case = "0"
    elif token.islower():
        case = "a"
    elif token.isupper():
        case = "A"
    else:
        case = "Aa" if token.istitle() else "x"
    return f"{case}{min(len(token).bit_length(), 6)}"


def _numbers(token: str) -> tuple[int, int]:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")), zlib.crc32(b"k:" + token_kind(token).encode())


def _bucket(*parts: np.ndarray) -> np.ndarray:
    """Bucket of n-grams, whose k-th members are in the k-th array."""
    mixed = np.full(len(parts[0]), len(parts), np.uint64)
    for part, mix in zip(parts, _MIX, strict=False):
        mixed = (mixed ^ part) * mix
        mixed ^= mixed >> np.uint64(29)
    return mixed & _MASK


def ngrams(texts: Sequence[str], known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts, with repeats, and the number of the text each is from."""
    tokens = [_TOKENS.findall(t) for t in texts]
    if len(known) > REMEMBERED:
        known.clear()
    for some in tokens:
        for token in some:
            if token not in known:
                known[token] = _numbers(token)
    sizes = [len(t) for t in tokens]
    pairs = np.array([known[t] for some in tokens for t in some], np.uint64).reshape(-1, 2)
    doc = np.repeat(np.arange(len(texts)), sizes)
    word, kind = pairs[:, 0], pairs[:, 1]
    next_in = doc[1:] == doc[:-1]
    again = np.zeros(len(doc), bool)
    again[1:] = next_in & (word[1:] == word[:-1])
    kind = kind + again.astype(np.uint64)
    kind2, word2 = (kind[:-1], kind[1:]), (word[:-1], word[1:])
    two = np.flatnonzero(next_in)
    three = np.flatnonzero(next_in[1:] & next_in[:-1]) if len(doc) > 2 else np.zeros(0, int)
    found = [
        (_bucket(word), doc),
        (_bucket(word2[0][two], word2[1][two]), doc[two]),
        (_bucket(kind), doc),
        (_bucket(kind2[0][two], kind2[1][two]), doc[two]),
        (_bucket(kind[three], kind[three + 1], kind[three + 2]), doc[three]),
    ]
    return np.concatenate([b for b, _ in found]).astype(np.int64), np.concatenate([d for _, d in found])


@dataclass
class Leader:
    """Follow the regularised leader, a row at a time: sums of gradients (`z`) and of squares (`n`)."""

    z: np.ndarray
    n: np.ndarray
    bias_z: float = 0.0
    bias_n: float = 0.0

    @classmethod
    def fresh(cls) -> Leader:
        return cls(np.zeros(1 << FEATURE_BITS), np.zeros(1 << FEATURE_BITS))

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        rate = (BETA + np.sqrt(self.n[at])) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / rate)

    def bias(self) -> float:
        return -self.bias_z / ((BETA + self.bias_n**0.5) / ALPHA)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int, importance: float) -> None:
        weights, bias = self.weights(at), self.bias()
        error = importance * (_logistic(bias + weights @ values) - label)
        gradient = error * values
        squares = self.n[at]
        added = squares + gradient**2
        self.z[at] += gradient - (np.sqrt(added) - np.sqrt(squares)) / ALPHA * weights
        self.n[at] = added
        step = ((self.bias_n + error**2) ** 0.5 - self.bias_n**0.5) / ALPHA
        self.bias_z += error - step * bias
        self.bias_n += error**2


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(
    texts: Sequence[str], labels: Sequence[int], rate: float, rounds: int = ROUNDS
) -> tuple[np.ndarray, float]:
    """Weights and bias from texts and labels (0 or 1); `rate` is the share of label 1 outside the sample.

    With one label only, or without rows, all weights are zero and the bias gives the rate.
    """
    ones = sum(labels)
    if not 0 < ones < len(labels) or not 0 < rate < 1:
        p = min(max(rate, 1e-6), 1 - 1e-6)
        return np.zeros(1 << FEATURE_BITS), float(np.log(p / (1 - p)))
    share = ones / len(labels)
    importance = ((1 - rate) / (1 - share), rate / share)
    leader, known = Leader.fresh(), {}
    for _ in range(rounds):
        for a, b in text_slices(texts):
            buckets, doc = ngrams(texts[a:b], known)
            order = np.argsort(doc, kind="stable")
            ends = np.searchsorted(doc[order], np.arange(b - a + 1))
            for i in range(b - a):
                own = buckets[order[ends[i] : ends[i + 1]]]
                at, counts = np.unique(own, return_counts=True)
                y = labels[a + i]
                leader.learn(at, counts * (SCALE / max(len(own), 1)), y, importance[y])
    return leader.weights(), leader.bias()


def score_texts(texts: Sequence[str], weights: np.ndarray, bias: float, known: dict) -> np.ndarray:
    """Probability of label 1 of each text; of a text without tokens that of the bias alone."""
    buckets, doc = ngrams(texts, known)
    total = np.bincount(doc, weights=weights[buckets], minlength=len(texts))
    number = np.bincount(doc, minlength=len(texts))
    return _logistic(bias + SCALE * total / np.maximum(number, 1))


def fit_from_labels(
    docs: DataFrame, labels: DataFrame, sample: Mapping[int, int] = SAMPLE, label: str = "quality"
) -> tuple[np.ndarray, float]:
    """Fit on a bounded sample of the labelled documents that are not held out, in one task.

    Labels other than 0 and 1, or without an id, do not count; of several labels of one document the
    highest does. Of rows that share an id the one whose text has the smallest hash is learned from.
    """
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).alias("_label"))
    )
    counts = {r["_label"]: r["n"] for r in usable.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    chosen = [
        hashed_sample(usable.where(F.col("_label") == y), F.col("doc_id"), sample[y], counts.get(y, 0))
        for y in (0, 1)
    ]
    total = sum(counts.values())
    rate = counts.get(1, 0) / total if total else 0.5
    # As many rows of two numbers as the sample has documents.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    rows = (
        rows.groupBy("doc_id", "_label")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .repartition(1)
        .select("doc_id", "text", "_label")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [row for b in batches for row in zip(*[c.to_pylist() for c in b.columns], strict=True)]
        # In an order that has nothing to do with ids or with tasks.
        held.sort(key=lambda row: (zlib.crc32(str(row[0]).encode()), row[0]))
        weights, bias = fit([t or "" for _, t, _ in held], [int(y) for *_, y in held], rate)
        columns = [pa.array([weights.tobytes()], pa.binary()), pa.array([float(bias)])]
        yield pa.RecordBatch.from_arrays(columns, ["weights", "bias"])

    fitted = rows.mapInArrow(run, "weights binary, bias double").first()
    if fitted is None:
        return fit([], [], rate)
    return np.frombuffer(fitted["weights"], np.float64), fitted["bias"]


def score_documents(
    docs: DataFrame, weights: np.ndarray, bias: float, text: str = "text", score: str = "score"
) -> DataFrame:
    """`docs` with the score added. Empty and null texts get the score of a document without words."""
    sent = docs.sparkSession.sparkContext.broadcast((weights, bias))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_cache("classifier")
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            for a, b in text_slices(texts):
                scores = score_texts(texts[a:b], *sent.value, known)
                some = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(scores, pa.float64())], [*some.schema.names, score]
                )

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(score, DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs`, repeated rows each.

    Only doc_id and text are read, and of labels doc_id and quality. Without usable labels of both kinds
    every score is the rate of label 1 among the usable ones, one half without any.
    """
    model = fit_from_labels(docs, labels)
    scored = score_documents(docs.select("doc_id", "text"), *model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
