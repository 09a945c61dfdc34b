"""Toxicity by a linear-chain conditional random field over words.

Labels are given for documents, so words are labelled first: a word, or the first five letters of
one, that stands in far more of the toxic documents than of the others marks an offending word in the
toxic ones. The field has two states per word, weights for hashed word features and for the steps
between states, and is fitted by gradient ascent on the likelihood; a chain ends with its sentence,
or after `CHAIN` words. Forward and backward passes give each word's marginal. With two states only
the ratio of their weights is needed, so a pass carries one number per chain, for all chains at once.

A document's score is a logistic function of its largest marginal and of the sum of them, fitted on
the training documents at the rate at which toxic ones occur. Offending words are those with a
marginal of one half or more.

Fitted in one task on a bounded sample, `SAMPLE` documents of each label at most, chosen by hash
among the labelled rows that may be used; everything is scored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tapeline.llm.common import hashed_sample, text_slices, with_others_aside

SAMPLE = {1: 800, 0: 2_400}
FEATURE_BITS = 18
CHAIN = 64
ROUNDS = 120
THRESHOLD = 0.7
# Training sentences: all with an offending word, and as many of the others as bring them to this number.
MOST_CHAINS = 20_000
REMEMBERED = 200_000

_TOKENS = re.compile(r"[^\W\d_]+|[.!?\n]")
_ENDS = frozenset(".!?\n")


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learned from: crc32 of its id modulo 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def word_features(word: str) -> list[int]:
    """Hashed features of a word: itself, its beginnings, its ending."""
    word = word.lower()
    parts = (f"w:{word}", f"4:{word[:4]}", f"5:{word[:5]}", f"e:{word[-3:]}")
    return [zlib.crc32(p.encode()) & ((1 << FEATURE_BITS) - 1) for p in parts]


@dataclass
class Model:
    """Weights of features, bias, log weights of steps and start, and of the document's score."""

    weights: np.ndarray
    bias: float
    steps: np.ndarray
    start: float
    document: tuple[float, float, float]

    def emission(self, word: str) -> float:
        return float(self.weights[word_features(word)].sum()) + self.bias


def _passes(
    odds: np.ndarray, lengths: np.ndarray, steps: np.ndarray, start: float
) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward ratios of chains, longest first, one row per place in the chain."""
    t = np.exp(steps)
    forward, backward = np.zeros_like(odds), np.ones_like(odds)
    open_at = np.searchsorted(-lengths, -np.arange(odds.shape[0]), side="left")
    ratio = np.full(odds.shape[1], math.exp(start))
    for i in range(odds.shape[0]):
        n = open_at[i]
        if i:
            ratio = (t[0, 1] + ratio[:n] * t[1, 1]) / (t[0, 0] + ratio[:n] * t[1, 0])
        ratio = odds[i, :n] * ratio[:n]
        forward[i, :n] = ratio
    for i in range(odds.shape[0] - 2, -1, -1):
        n = open_at[i + 1]
        after = odds[i + 1, :n] * backward[i + 1, :n]
        backward[i, :n] = (t[1, 0] + t[1, 1] * after) / (t[0, 0] + t[0, 1] * after)
    return forward, backward


def _chains(chain_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lay words out by chain: row (place) and column (chain, longest first) of each, and lengths."""
    begins = np.flatnonzero(np.diff(chain_of, prepend=-1))
    lengths = np.diff(np.append(begins, len(chain_of)))
    order = np.argsort(-lengths, kind="stable")
    column = np.empty(len(lengths), np.int64)
    column[order] = np.arange(len(lengths))
    place = np.arange(len(chain_of)) - np.repeat(begins, lengths)
    return place, np.repeat(column, lengths), lengths[order]


def _cut(is_end: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Chain numbers of words: new after a sentence end, with a new document, after CHAIN words."""
    words = np.flatnonzero(~is_end)
    sentence = np.cumsum(is_end)[words] * 1.0 + doc[words] * (len(is_end) + 1.0)
    new = np.diff(sentence, prepend=-1.0) != 0
    begins = np.maximum.accumulate(np.where(new, np.arange(len(words)), 0))
    new |= (np.arange(len(words)) - begins) % CHAIN == 0
    return np.cumsum(new) - 1


def marginals(model: Model, emission: np.ndarray, chain_of: np.ndarray) -> np.ndarray:
    """Probability of each word to be offending, given its chain."""
    if not len(emission):
        return np.empty(0)
    place, column, lengths = _chains(chain_of)
    odds = np.ones((int(lengths[0]), len(lengths)))
    odds[place, column] = np.exp(np.clip(emission, -30, 30))
    forward, backward = _passes(odds, lengths, model.steps, model.start)
    ratio = forward[place, column] * backward[place, column]
    return ratio / (1 + ratio)


def offending(coded: list[np.ndarray], toxic: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which groups of tokens stand in far more of the toxic documents than of the others."""
    seen = np.zeros((2, int(group.max(initial=-1)) + 1))
    for tokens, y in zip(coded, toxic.tolist(), strict=True):
        seen[y, np.unique(group[tokens])] += 1
    n, m = max(int((toxic == 1).sum()), 1), max(int((toxic == 0).sum()), 1)
    return (seen[1] >= 3) & (seen[1] / n >= 30 * (seen[0] + 0.5) / m)


def fit(
    texts: list[str], toxic: list[int], base_rate: float, most_chains: int = MOST_CHAINS
) -> Model:
    """Fit the field and the document score. Without documents of both kinds the score is constant.

    The field is fitted on all sentences with an offending word and an even choice of the others, about
    `most_chains` in all; the document score on all texts, whole.
    """
    toxic = np.array(toxic, np.int64)
    # Every text as numbers of its tokens.
    number: dict[str, int] = {}
    coded = [
        np.array([number.setdefault(t.lower(), len(number)) for t in _TOKENS.findall(text)], np.int32)
        for text in texts
    ]
    tokens = list(number)
    beginning: dict[str, int] = {}
    of_beginning = np.array([beginning.setdefault(t[:5], len(beginning)) for t in tokens], np.int32)
    by_word = offending(coded, toxic, np.arange(len(tokens)))
    by_beginning = offending(coded, toxic, of_beginning)[of_beginning]
    size = np.array([0 if t in _ENDS else len(t) for t in tokens])
    marked = (by_word & (size > 2)) | (by_beginning & (size >= 5))
    model = Model(np.zeros(1 << FEATURE_BITS), -6.0, np.zeros((2, 2)), -3.0, (0.0, 0.0, 0.0))
    rate = min(max(base_rate, 1e-6), 1 - 1e-6)
    # Where nothing can be learned nothing is called toxic.
    constant = min(rate, 0.5)
    model.document = (math.log(constant / (1 - constant)), 0.0, 0.0)
    if not marked.any():
        return model

    flat = np.concatenate(coded)
    doc = np.repeat(np.arange(len(coded)), [len(c) for c in coded])
    is_end = np.array([t in _ENDS for t in tokens], bool)[flat]
    all_chains = _cut(is_end, doc)
    kept, doc = flat[~is_end], doc[~is_end]
    features = np.fromiter(
        (f for t in tokens for f in word_features(t)), np.int32, 4 * len(tokens)
    ).reshape(-1, 4)
    label = marked[kept] & (toxic[doc] == 1)

    # All chains with an offending word, and an even choice of the others.
    has = np.bincount(all_chains, weights=label) > 0
    plain = np.flatnonzero(~has)
    step = max(1, math.ceil(len(plain) / max(1, most_chains - int(has.sum()))))
    has[plain[::step]] = True
    use = has[all_chains]
    model = _fit_chains(model, features[kept[use]], label[use].astype(float), all_chains[use])

    # The document's score.
    emission = model.weights[features].sum(axis=1) + model.bias
    is_end = np.array([t in _ENDS for t in tokens], bool)
    parts = [_evidence(*_totals(model, emission, is_end, coded[i : i + 200]))
             for i in range(0, len(coded), 200)]
    evidence = np.concatenate(parts, axis=1)
    x = np.stack([np.ones(len(coded)), *evidence], axis=1)
    weight = np.where(toxic == 1, rate / max(toxic.mean(), 1e-9),
                      (1 - rate) / max(1 - toxic.mean(), 1e-9))
    beta = np.zeros(3)
    for _ in range(25):
        q = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (weight * (toxic - q)) - 0.1 * beta
        hessian = (x * (weight * q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(3)
        beta = beta + np.linalg.solve(hessian, gradient)
    model.document = tuple(float(b) for b in beta)
    return model


def _totals(
    model: Model, emission: np.ndarray, is_end: np.ndarray, coded: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Largest marginal and sum of marginals of some documents, given as numbers of tokens."""
    flat = np.concatenate(coded)
    doc = np.repeat(np.arange(len(coded)), [len(c) for c in coded])
    ends = is_end[flat]
    p = marginals(model, emission[flat[~ends]], _cut(ends, doc))
    return _aggregate(p, doc[~ends], len(coded))


def _fit_chains(model: Model, features: np.ndarray, label: np.ndarray, chain: np.ndarray) -> Model:
    """Adam on the likelihood of the labelled chains, with a small pull of all weights to zero."""
    place, column, lengths = _chains(chain)
    used, features = np.unique(features, return_inverse=True)
    features = features.reshape(len(label), -1)
    follows = np.flatnonzero(place > 0)
    pair = (2 * label[follows - 1] + label[follows]).astype(int)
    observed = np.bincount(pair, minlength=4)
    first = place == 0
    theta = np.concatenate([np.zeros(len(used)), [-4.0], np.zeros(4), [-3.0]])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    n = len(used)
    for i in range(1, ROUNDS + 1):
        weights, bias, steps, start = theta[:n], theta[n], theta[n + 1 : n + 5], theta[n + 5]
        odds = np.ones((int(lengths[0]), len(lengths)))
        odds[place, column] = np.exp(np.clip(weights[features].sum(axis=1) + bias, -30, 30))
        forward, backward = _passes(odds, lengths, steps.reshape(2, 2), start)
        ratio = forward[place, column] * backward[place, column]
        p = ratio / (1 + ratio)
        at, col = place[follows], column[follows]
        before, after = forward[at - 1, col], odds[at, col] * backward[at, col]
        both = np.exp(steps)[:, None] * np.stack(
            [np.ones(len(at)), after, before, before * after]
        )
        expected = (both / both.sum(axis=0)).sum(axis=1)
        wrong = label - p
        gradient = np.concatenate(
            [
                np.bincount(features.ravel(), np.repeat(wrong, features.shape[1]), minlength=n),
                [wrong.sum()],
                observed - expected,
                [wrong[first].sum()],
            ]
        ) - 0.05 * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta + 0.15 * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-8)
    model.weights[used] = theta[:n]
    model.bias, model.steps, model.start = theta[n], theta[n + 1 : n + 5].reshape(2, 2), theta[n + 5]
    return model


def _aggregate(p: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest marginal and sum of marginals of each document; 0 without words."""
    most = np.zeros(n)
    if len(p):
        begins = np.flatnonzero(np.diff(doc, prepend=-1))
        most[doc[begins]] = np.maximum.reduceat(p, begins)
    return most, np.bincount(doc, weights=p, minlength=n)


def _evidence(most: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    clipped = np.clip(most, 1e-4, 1 - 1e-4)
    return np.log(clipped / (1 - clipped)) / 4 + 2.3, np.log1p(total)


def fit_from_labels(
    docs: DataFrame,
    labels: DataFrame,
    sample: Mapping[int, int] = SAMPLE,
    most_chains: int = MOST_CHAINS,
) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out.

    `most_chains` bounds the sentences of the sample that the field is fitted on, see `fit`.

    Labels other than 0 and 1, or without an id, do not count; of several labels of one document the highest does.
    """
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for value in (0, 1):
        some = usable.where(F.col("toxic") == value)
        some = hashed_sample(some, F.col("doc_id"), sample[value], counts.get(value, 0))
        chosen = some if chosen is None else chosen.unionByName(some)
    total = sum(counts.values())
    rate = counts.get(1, 0) / total if total else 0.0
    # As many rows of two numbers as the sample has documents; the fit is one task's work.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # Of rows that share an id, the one whose text has the smallest hash.
    rows = (
        rows.groupBy("doc_id", "toxic")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .repartition(1)
        .select("doc_id", "text", "toxic")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(
            ((i, t or "", y) for batch in batches for i, t, y in zip(
                *[column.to_pylist() for column in batch.columns], strict=True)),
            key=lambda row: row[0],
        )
        model = fit([t for _, t, _ in found], [y for _, _, y in found], rate, most_chains)
        numbers = [model.bias, model.start, *model.steps.ravel(), *model.document]
        columns = [
            pa.array([model.weights.tobytes()], pa.binary()),
            pa.array([[float(x) for x in numbers]], pa.list_(pa.float64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["weights", "numbers"])

    fitted = rows.mapInArrow(run, "weights binary, numbers array<double>").first()
    if fitted is None:
        return fit([], [], rate)
    bias, start, *rest = fitted["numbers"]
    weights = np.frombuffer(fitted["weights"], np.float64)
    return Model(weights, bias, np.array(rest[:4]).reshape(2, 2), start, tuple(rest[4:]))


class _Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, float] = {}

    def lookup(self, token: str) -> float:
        return math.nan if token in _ENDS else self.model.emission(token)

    def score(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Score of each text, and the offsets in its words that offend."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        tokens = [_TOKENS.findall(t) for t in texts]
        for token in {t for doc in tokens for t in doc if t not in known}:
            known[token] = self.lookup(token)
        sizes = [len(d) for d in tokens]
        emission = np.fromiter(
            (known[t] for doc in tokens for t in doc), np.float64, sum(sizes)
        )
        doc = np.repeat(np.arange(len(texts)), sizes)
        is_end = np.isnan(emission)
        words = ~is_end
        p = marginals(self.model, emission[words], _cut(is_end, doc))
        most, total = _aggregate(p, doc[words], len(texts))
        a, b, c = self.model.document
        x, y = _evidence(most, total)
        score = 1 / (1 + np.exp(-(a + b * x + c * y)))
        offending: list[list] = [[] for _ in texts]
        begins = np.cumsum([0, *sizes])
        for at in np.flatnonzero(words)[p >= 0.5]:
            offending[doc[at]].append(int(at - begins[doc[at]]))
        return score, offending


def _spans(text: str, offending: list[int]) -> list[dict]:
    """Start and end (code points) of the tokens with the given numbers."""
    if not offending:
        return []
    found = list(_TOKENS.finditer(text))
    return [{"start": found[i].start(), "end": found[i].end()} for i in offending]


def score_documents(
    docs: DataFrame, model: Model, text: str = "text", score: str = "score", spans: str | None = None
) -> DataFrame:
    """`docs` with the score added, and with `spans` the offending offsets.

    Empty and null texts get the score of a document without words. Repeated rows are each scored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))
    at = docs.columns.index(text)
    extra = [score, spans] if spans else [score]
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(Model(**sent.value))
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            for a, b in text_slices(texts):
                scores, offending = scorer.score(texts[a:b])
                added = [pa.array(scores, pa.float64())]
                if spans:
                    found = [_spans(t, o) for t, o in zip(texts[a:b], offending, strict=True)]
                    added.append(pa.array(found, pa.list_(span)))
                some = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, *added], [*some.schema.names, *extra]
                )

    kinds = StructType.fromDDL("score double, spans array<struct<start: int, end: int>>")
    fields = [StructField(n, k.dataType) for n, k in zip(extra, kinds, strict=False)]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *fields]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and the offending spans of every document."""
    model = fit_from_labels(docs, labels)
    scored = score_documents(docs.select("doc_id", "text"), model, spans="spans")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
        "spans",
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted to be toxic, as they are."""
    model = fit_from_labels(docs, labels)

    def kept(rows: DataFrame) -> DataFrame:
        scored = score_documents(rows, model, score="_toxicity")
        return scored.where(F.col("_toxicity") < THRESHOLD).drop("_toxicity")

    return with_others_aside(docs, ["doc_id", "text"], kept)
