"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element and every run of text is a node with a state, content or not. A node's potential is
linear in hashed features (tag, words of class and id, length of text, share of links, depth); the
potential between a parent and its child depends on the kind of the child. Sum-product passes, from
the leaves up and from the root down, give each node's marginal exactly, as the graph is a tree; all
trees of a batch are passed at once, depth by depth. The main text is the text whose marginal is one
half or more.

Parts that are never content (scripts, forms, menus, adverts, comments) are evidence, not a guess: such a
node is out, and all below it follows its parent. These nodes, and elements that hold no text, are tied
to their parents one way, by the chance of their state given the parent's; they send nothing up, so
a paragraph with ten scripts in it is what it is without them.

Trained from labelled pages: those that mark their article themselves (an article or main element, or
the like) label the nodes that are not evidence by it. So what is learned is what the lists do not
have: the class names and the shape of a site's own regions. Weights start from, and are pulled to, what
is known of tags and class words beforehand. The sample is at most `SAMPLE` pages, chosen by hash, and is
fitted in one task; all pages are extracted.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import hashed_sample, text_slices

SAMPLE = 400
FEATURE_BITS = 14
ROUNDS = 60

# Names of HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp noembed template svg".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
# Elements that begin a line of their own; all others are part of the text around them.
BLOCKS = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html"
    " legend li listing main menu nav ol optgroup option p plaintext pre search section summary table"
    " tbody td tfoot th thead title tr ul xmp".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table"
    " ul".split()
)
# An element that ends when one of the same group begins, up to the element that holds both.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

# What is known beforehand: never content, and where content is marked.
NEVER_TAGS = frozenset(
    "head title script style noscript nav header footer aside form button select option textarea"
    " input label iframe template svg dialog menu fieldset canvas object embed audio video".split()
)
NEVER_WORDS = frozenset(
    "ad ads advert advertisement adverts sponsor sponsored banner promo cookie cookies consent notice"
    " notices alert popup modal overlay sidebar aside widget menu nav navbar navigation breadcrumb"
    " breadcrumbs header masthead footer copyright share sharing social related recommended comment"
    " comments respond reply replies newsletter subscribe signup login search toolbar pagination pager"
    " skip hidden".split()
)
CONTENT_TAGS = frozenset("article main".split())
CONTENT_WORDS = frozenset(
    "article articlebody content entry main maincontent post postbody story".split()
)

# An attribute: its name, and after '=' its value. A quote begins a value only right after '='; any other
# quote is a plain character of a name or of a value without quotes.
_ATTRIBUTE = (
    r"(?:[^\s/>][^\s/>=]*+)"
    r"(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+"
)
# A comment, tag or quoted value that is not closed goes on to the end of the page.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE})*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_MARKS = re.compile(_ATTRIBUTE)
_NAMES = frozenset("class id role itemprop hidden aria-hidden".split())
# Class names that hide what overflows, a back or a border, not the text.
_CLIPS = re.compile(r"\b(overflow|backface|border)((?:[-_][a-z]+)*?)[-_]+hidden\b")
_WORD = re.compile(r"[a-z]+|\d+")


class Tree:
    """The nodes of a page in page order, a parent before its children; node 0 is the page."""

    __slots__ = ("parent", "tag", "words", "text", "block", "depth")

    def __init__(self, source: str):
        self.parent, self.tag, self.words, self.text = [0], ["#page"], [()], [""]
        self.block, self.depth = [0], [0]
        open_nodes = [0]
        block = at = 0
        for match in _TOKEN.finditer(source):
            if match.start() < at:
                continue
            if match.start() > at:
                self._text(source[at : match.start()], open_nodes[-1], block)
            at = match.end()
            close, name, marks = match.groups()
            if name is None:
                continue
            name = name.lower()
            if name in BLOCKS:
                block += 1
            if close:
                self._end(open_nodes, name)
                continue
            self._begin(open_nodes, name)
            node = self._add(open_nodes[-1], name, _mark_words(marks) if marks else (), "", block)
            if name == "br":
                self._text(" ", open_nodes[-1], block)
            # Elements that hold no text of the page are skipped to their end tag.
            if name in RAW:
                end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(source, at)
                at = end.end() if end else len(source)
            elif name not in VOID:
                open_nodes.append(node)
        if at < len(source):
            self._text(source[at:], open_nodes[-1], block)

    def _add(self, parent: int, tag: str, words: tuple, text: str, block: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.words.append(words)
        self.text.append(text)
        self.block.append(block)
        self.depth.append(self.depth[parent] + 1)
        return len(self.tag) - 1

    def _text(self, raw: str, parent: int, block: int) -> None:
        self._add(parent, "#text", (), html.unescape(raw) if "&" in raw else raw, block)

    def _begin(self, open_nodes: list[int], name: str) -> None:
        """End the elements that the beginning of this one ends."""
        if name in CLOSES_P:
            for i in range(len(open_nodes) - 1, 0, -1):
                if self.tag[open_nodes[i]] == "p":
                    del open_nodes[i:]
                    break
                if self.tag[open_nodes[i]] not in INLINE:
                    break
        if name in SIBLINGS:
            ends, within = SIBLINGS[name]
            for i in range(len(open_nodes) - 1, 0, -1):
                tag = self.tag[open_nodes[i]]
                if tag in within:
                    break
                if tag in ends:
                    del open_nodes[i:]

    def _end(self, open_nodes: list[int], name: str) -> None:
        for i in range(len(open_nodes) - 1, 0, -1):
            if self.tag[open_nodes[i]] == name:
                del open_nodes[i:]
                return


def _mark_words(marks: str) -> tuple:
    words: list[str] = []
    for mark in _MARKS.findall(marks):
        name, _, value = mark.partition("=")
        name, value = name.strip().lower(), value.strip()
        if name not in _NAMES:
            continue
        if name in ("hidden", "aria-hidden"):
            if value.strip("\"'") != "false":
                words.append("hidden")
        else:
            joined = value.strip("\"'").lower()
            words += _WORD.findall(_CLIPS.sub(r"\1\2", joined))
            words.append(joined.replace("-", "").replace("_", "").replace(" ", ""))
    return tuple(dict.fromkeys(words))


def _hashed(feature: str) -> int:
    return zlib.crc32(feature.encode()) & ((1 << FEATURE_BITS) - 1)


def _bin(n: float) -> int:
    return int(n).bit_length()


@dataclass
class Model:
    """Weights of features, and log potentials of (parent, child) states by kind of child."""

    weights: np.ndarray
    pairs: np.ndarray


# Kinds of children: text, inline element, block element; and what stands below an element that is out,
# which is out as well.
_BELOW_OUT = 3
_FOLLOWS = np.array([[[60.0, 0.0], [0.0, 0.0]]])
_OUT = -30.0


def _kind(tag: str) -> int:
    return 0 if tag == "#text" else 2 if tag in BLOCKS else 1


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return most + np.log(np.exp(x - most).sum(axis=axis, keepdims=True))


class Forest:
    """Trees of several pages as arrays.

    With `twice` every page is there once more, its features without the marks of an article.
    """

    def __init__(self, pages: list[str], cache: dict[str, int], twice: bool = False):
        self.trees = [Tree(page) for page in pages] * (2 if twice else 1)
        n_whole = len(pages)
        sizes = [len(t.tag) for t in self.trees]
        first = np.cumsum([0, *sizes])
        self.first = first
        self.parent = np.concatenate(
            [np.array(t.parent) + f for t, f in zip(self.trees, first, strict=False)] or [np.empty(0)]
        ).astype(np.int64)
        self.depth = np.array([d for t in self.trees for d in t.depth], np.int64)
        self.kind = np.array([_kind(g) for t in self.trees for g in t.tag], np.int64)
        chars = np.array([len(x.strip()) for t in self.trees for x in t.text], np.float64)
        in_link = np.array([g == "a" for t in self.trees for g in t.tag], bool)
        self.levels = [np.flatnonzero(self.depth == d) for d in range(1, int(self.depth.max(initial=0)) + 1)]
        total, linked = chars.copy(), np.zeros_like(chars)
        for level in reversed(self.levels):
            linked[level] = np.where(in_link[level], total[level], linked[level])
            np.add.at(total, self.parent[level], total[level])
            np.add.at(linked, self.parent[level], linked[level])
        self._evidence(total)
        share = np.round(4 * linked / np.maximum(total, 1)).astype(int)
        length = np.array([_bin(c) for c in total])
        nodes, features = [], []
        i = 0
        for number, tree in enumerate(self.trees):
            seen = tree.tag if number < n_whole else ["div" if g in CONTENT_TAGS else g for g in tree.tag]
            for j, (tag, words) in enumerate(zip(seen, tree.words, strict=True)):
                parent = seen[tree.parent[j]]
                if number >= n_whole:
                    words = [w for w in words if w not in CONTENT_WORDS]
                names = [
                    f"tag:{tag}",
                    f"in:{parent}:{tag}",
                    f"length:{min(self.kind[i], 1)}:{length[i]}",
                    f"links:{share[i]}",
                    *[f"word:{w}" for w in words],
                ]
                for name in names:
                    nodes.append(i)
                    known = cache.get(name)
                    if known is None:
                        known = cache[name] = _hashed(name)
                    features.append(known)
                i += 1
        self.nodes, self.features = np.array(nodes, np.int64), np.array(features, np.int64)

    def _evidence(self, chars: np.ndarray) -> None:
        """`out`: nodes that are never content. `silent`: those, all below them, and what holds no text.

        An element is not out by its name or class if it holds all of the marked articles of its page, as a
        form or a "has-sidebar" around everything does, nor by its class if it holds most of the text.
        """
        n = len(self.parent)
        tags = [g for t in self.trees for g in t.tag]
        words = [w for t in self.trees for w in t.words]
        by_tag = np.array([g in NEVER_TAGS for g in tags], bool)
        by_word = np.array([g not in ("html", "body") and any(x in NEVER_WORDS for x in w)
                            for g, w in zip(tags, words, strict=True)], bool)
        marked = np.array([g in CONTENT_TAGS for g in tags], float)
        below = marked.copy()
        for level in reversed(self.levels):
            np.add.at(below, self.parent[level], below[level])
        page = np.repeat(self.first[:-1], np.diff(self.first))
        holds_all = (below > marked) & (below == below[page]) if n else np.zeros(0, bool)
        holds_most = 2 * chars > chars[page] if n else np.zeros(0, bool)
        unmarked = below[page] == 0 if n else np.zeros(0, bool)
        self.out = (by_tag | by_word & ~(holds_most & unmarked)) & ~holds_all
        inside = np.zeros(n, bool)
        for level in self.levels:
            up = self.parent[level]
            inside[level] = inside[up] | self.out[up]
        self.kind[inside] = _BELOW_OUT
        empty = np.array([g in VOID or g in RAW for g in tags], bool)
        self.silent = self.out | inside | empty

    def passes(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginal of each node, and the beliefs of (parent, child) states, by sum-product."""
        n = len(self.parent)
        field = np.bincount(self.nodes, weights=model.weights[self.features], minlength=n)
        field[self.out] = _OUT
        local = np.stack([np.zeros(n), np.clip(field, -40, 40)], axis=1)
        up = local.copy()
        message = np.zeros((n, 2))
        # By level: log potentials of (parent, child) states, with all that is known from the child down.
        edges: list[np.ndarray] = []
        pairs_of = np.concatenate([model.pairs, _FOLLOWS])
        for level in reversed(self.levels):
            edge = pairs_of[self.kind[level]] + up[level][:, None, :]
            silent = self.silent[level]
            edge[silent] -= _log_sum(edge[silent], axis=2)
            edges.append(edge)
            sent = _log_sum(edge, axis=2)[:, :, 0]
            sent -= sent.max(axis=1, keepdims=True)
            sent[silent] = 0.0
            message[level] = sent
            np.add.at(up, self.parent[level], sent)
        belief = up.copy()
        pairs = np.zeros((n, 2, 2))
        for level, edge in zip(self.levels, reversed(edges), strict=True):
            rest = belief[self.parent[level]] - message[level]
            joint = rest[:, :, None] + edge
            joint -= joint.max(axis=(1, 2), keepdims=True)
            joint = np.exp(joint)
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            pairs[level] = joint
            belief[level] = np.log(np.maximum(joint.sum(axis=1), 1e-300))
        p = np.exp(belief - np.logaddexp(belief[:, :1], belief[:, 1:]))[:, 1]
        return p, pairs, local

    def main_texts(self, p: np.ndarray) -> list[str]:
        found = []
        for tree, first in zip(self.trees, self.first.tolist(), strict=False):
            blocks: dict[int, list[str]] = {}
            for j, text in enumerate(tree.text):
                if text and p[first + j] >= 0.5:
                    blocks.setdefault(tree.block[j], []).append(text)
            joined = (" ".join("".join(parts).split()) for parts in blocks.values())
            found.append("\n".join(text for text in joined if text))
        return found


def known_labels(tree: Tree) -> list[int] | None:
    """Labels of a page that marks its article, or null for one that does not."""
    marked = [
        i
        for i, (tag, words) in enumerate(zip(tree.tag, tree.words, strict=True))
        if tag in CONTENT_TAGS or "articlebody" in words
    ]
    if not marked:
        return None
    state = [0] * len(tree.tag)
    for i in range(1, len(tree.tag)):
        never = tree.tag[i] in NEVER_TAGS or any(w in NEVER_WORDS for w in tree.words[i])
        inside = state[tree.parent[i]] or i in marked
        state[i] = int(bool(inside) and not never)
        # Once out, nothing below is in again: marked elements inside such parts are not articles.
        if never:
            state[i] = -1
        elif state[tree.parent[i]] == -1:
            state[i] = -1
    return [int(s == 1) for s in state]


def prior_model() -> Model:
    weights = np.zeros(1 << FEATURE_BITS)
    for names, value in (
        ([f"tag:{t}" for t in NEVER_TAGS], -8.0),
        ([f"word:{w}" for w in NEVER_WORDS], -8.0),
        ([f"tag:{t}" for t in CONTENT_TAGS], 6.0),
        ([f"word:{w}" for w in CONTENT_WORDS], 4.0),
        (["tag:#page", "tag:html", "tag:body"], -3.0),
        (["tag:p", "tag:h1", "tag:blockquote", "tag:pre"], 1.5),
        ([f"length:0:{b}" for b in range(7, 24)], 0.5),
        (["links:3", "links:4"], -1.5),
    ):
        for name in names:
            weights[_hashed(name)] += value
    pairs = np.zeros((3, 2, 2))
    # Text and inline elements are what their parent is; a block may begin content, or end it.
    pairs[:2, 0, 0] = pairs[:2, 1, 1] = 3.0
    pairs[2, 0, 0] = pairs[2, 1, 1] = 1.5
    return Model(weights, pairs)


def fit(pages: list[str]) -> Model:
    """Maximum a posteriori by gradient ascent; exact gradients from the passes.

    Every page is learned from twice, as it is and without the marks that its labels come from: what else
    its article and its other parts are known by is learned from the second.
    """
    prior, model = prior_model(), prior_model()
    forest = Forest([p for p in pages if p], {}, twice=True)
    labels, known = [], []
    for tree in forest.trees:
        found = known_labels(tree)
        known += [found is not None] * len(tree.tag)
        labels += found or [0] * len(tree.tag)
    # Evidence needs no learning, and teaches nothing.
    known, labels = np.array(known, bool) & ~forest.silent, np.array(labels, np.int64)
    if not known.any():
        return model
    child = known & (forest.depth > 0)
    observed = np.zeros((3, 2, 2))
    np.add.at(observed, (forest.kind[child], labels[forest.parent[child]], labels[child]), 1)
    theta = [model.weights, model.pairs]
    means, squares = ([np.zeros_like(x) for x in theta] for _ in range(2))
    for i in range(1, ROUNDS + 1):
        p, pairs, _ = forest.passes(model)
        expected = np.zeros((3, 2, 2))
        np.add.at(expected, forest.kind[child], pairs[child])
        wrong = np.where(known, labels - p, 0.0)
        gradients = [
            np.bincount(forest.features, wrong[forest.nodes], minlength=len(model.weights))
            - 1.0 * (model.weights - prior.weights),
            observed - expected - 1.0 * (model.pairs - prior.pairs),
        ]
        for x, g, mean, square in zip(theta, gradients, means, squares, strict=True):
            mean += 0.1 * (g - mean)
            square += 0.01 * (g**2 - square)
            x += 0.1 * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-8)
    return model


def fit_from_pages(pages: DataFrame, page: str = "html", sample: int = SAMPLE) -> Model:
    """Fit on a bounded sample of the pages, in one task; the model has a fixed size."""
    rows = pages.where(F.col(page).isNotNull()).select(F.col(page).alias("_page"))
    chosen = hashed_sample(rows, F.col("_page"), sample, rows.count()).select("_page").repartition(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = fit(sorted(text for batch in batches for text in batch.column(0).to_pylist()))
        columns = [pa.array([x.tobytes()], pa.binary()) for x in (model.weights, model.pairs)]
        yield pa.RecordBatch.from_arrays(columns, ["weights", "pairs"])

    fitted = chosen.mapInArrow(run, "weights binary, pairs binary").first()
    if fitted is None:
        return prior_model()
    pairs = np.frombuffer(fitted["pairs"], np.float64).reshape(3, 2, 2)
    return Model(np.frombuffer(fitted["weights"], np.float64), pairs)


def main_text(
    pages: DataFrame, model: Model, page: str = "html", text: str = "text", n_chars: str = "n_chars"
) -> DataFrame:
    """`pages` without `page`, with the main text and its length in code points.

    A page without main text, an empty page and a null give the empty text. Each row is a page of
    its own; other columns stay, but for those named like what is made here. References to characters are decoded, white space in a block becomes
    one space, blocks are joined by line ends.
    """
    sent = pages.sparkSession.sparkContext.broadcast((model.weights, model.pairs))
    kept = [c for c in pages.columns if c not in (page, text, n_chars)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained, cache = Model(*sent.value), {}
        for batch in batches:
            sources = [s or "" for s in batch.column(len(kept)).to_pylist()]
            for a, b in text_slices(sources):
                forest = Forest(sources[a:b], cache)
                texts = forest.main_texts(forest.passes(trained)[0])
                added = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                some = batch.slice(a, b - a).columns[: len(kept)]
                yield pa.RecordBatch.from_arrays([*some, *added], [*kept, text, n_chars])
                if len(cache) > 200_000:
                    cache.clear()

    schema = pages.select(*kept).withColumns(
        {text: F.lit("").cast("string"), n_chars: F.lit(0).cast("bigint")}
    ).schema
    return pages.select(*kept, page).mapInArrow(run, schema)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page, by a model fitted on some of them."""
    rows = pages.select("page_id", "url", "html")
    return main_text(rows, fit_from_pages(rows))
