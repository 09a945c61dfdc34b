"""BPE encoding and decoding with word ends, by forced boundaries.

A pair of neighbouring bytes that stands inside no token of the vocabulary can never be merged
across: it is a certain cut. Words are cut there, every fragment is encoded by itself, and the ids
are put together again. All fragments of a batch are merged side by side on arrays: in every round
each fragment applies its pair of lowest rank, until no fragment has a pair left.

The result is that of the `tokenizers` library for the same file (a BPE model with word ends, NFC,
lower case, white space dropped), without special tokens added. The strings of special tokens in a
text become their ids, as there.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import text_slices, worker_cache

# Words that a worker remembers before it starts anew.
REMEMBERED = 300_000

_WORD_END = "</w>"


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 upwards."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class WordBpe:
    """Tables of a tokenizer file, and the words seen so far."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.n = max(vocabulary.values()) + 1
        tokens = {i: token for token, i in vocabulary.items()}
        special = {added["content"]: added["id"] for added in spec["added_tokens"]}
        tokens |= {i: token for token, i in special.items()}
        self.token_of = {str(i): token for i, token in tokens.items()}
        self.special = {token: str(i) for token, i in special.items()}
        longest_first = sorted(special, key=len, reverse=True)
        self.split_special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        splitter = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words_of = regex.compile(splitter).findall

        characters = byte_characters()
        self.inner = np.array([vocabulary[c] for c in characters])
        self.last = np.array([vocabulary[c + _WORD_END] for c in characters])
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        keys = np.array([vocabulary[a] * self.n + vocabulary[b] for a, b in pairs])
        made = np.array([vocabulary[a + b] for a, b in pairs])
        by_key = np.argsort(keys)
        self.keys, self.rank, self.made = keys[by_key], by_key, made[by_key]
        self.never = never_adjacent(vocabulary, characters)
        self.words: dict[str, str] = {}

    def normal(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        # Lower case of each character by itself: only the capital sigma depends on its place.
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()

    def split(self, text: str) -> list[str]:
        """Words and special tokens of a text, in order."""
        if "<|" not in text:
            return self.words_of(self.normal(text))
        found: list[str] = []
        for i, part in enumerate(self.split_special.split(text)):
            found += [part] if i % 2 else self.words_of(self.normal(part))
        return found

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet."""
        new = [w for w in dict.fromkeys(words) if w not in self.words]
        for first in range(0, len(new), 100_000):
            some = new[first : first + 100_000]
            self.words.update(zip(some, self.encode_words(some), strict=True))

    def encode_words(self, words: list[str]) -> list[str]:
        """Ids of each word, as decimal numbers joined by a space."""
        raw = [w.encode() for w in words]
        ends = np.cumsum([len(b) for b in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        starts_word = np.zeros(len(data), bool)
        starts_word[0] = True
        starts_word[ends[:-1]] = True
        symbols = self.inner[data]
        symbols[ends - 1] = self.last[data[ends - 1]]
        cut = starts_word.copy()
        cut[1:] |= self.never[data[:-1], data[1:]]
        merged = self.merge(symbols, np.cumsum(cut) - 1)
        at = np.flatnonzero(merged >= 0)
        ids = list(map(str, merged[at].tolist()))
        bounds = np.searchsorted(at, ends).tolist()
        return [" ".join(ids[a:b]) for a, b in zip([0, *bounds], bounds, strict=False)]

    def merge(self, symbols: np.ndarray, fragment: np.ndarray) -> np.ndarray:
        """Merge inside fragments. Returns the ids at the places where their tokens begin, else -1."""
        done = np.full(len(symbols), -1, np.int64)
        place = np.arange(len(symbols))
        never = len(self.rank)
        while len(symbols):
            key = symbols[:-1] * self.n + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            fits = (self.keys[at] == key) & (fragment[:-1] == fragment[1:])
            rank = np.append(np.where(fits, self.rank[at], never), never)
            begins = np.flatnonzero(np.diff(fragment, prepend=-1))
            best = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.append(begins, len(symbols)))
            best = np.repeat(best, sizes)
            over = best == never
            done[place[over]] = symbols[over]
            chosen = (rank == best) & ~over
            # Of equal pairs that overlap, every second one from the left.
            where = np.arange(len(chosen))
            run = np.maximum.accumulate(np.where(chosen, -1, where))
            chosen &= (where - run) % 2 == 1
            left = np.flatnonzero(chosen)
            symbols = symbols.copy()
            symbols[left] = self.made[at[left]]
            keep = ~over
            keep[left + 1] = False
            symbols, fragment, place = symbols[keep], fragment[keep], place[keep]
        return done

    def encode(self, texts: list[str]) -> list[str]:
        """Ids of each text, as decimal numbers joined by a space."""
        split = [self.split(text) for text in texts]
        if len(self.words) > REMEMBERED:
            self.words = {}
        self.words |= self.special
        self.learn([w for words in split for w in words])
        known = self.words.__getitem__
        return [" ".join(map(known, words)) for words in split]

    def decode(self, ids: str) -> str:
        return " ".join(map(self.token_of.__getitem__, ids.split(" "))) if ids else ""


def never_adjacent(vocabulary: dict[str, int], characters: list[str]) -> np.ndarray:
    """For every two bytes, whether no token has the one right before the other."""
    byte_of = {c: b for b, c in enumerate(characters)}
    never = np.ones((256, 256), bool)
    for token in vocabulary:
        bare = token.removesuffix(_WORD_END)
        inside = [byte_of[c] for c in bare if c in byte_of]
        if len(inside) == len(bare):
            never[inside[:-1], inside[1:]] = False
    return never


def word_bpe(path: str) -> WordBpe:
    held = worker_cache("word_bpe")
    if path not in held:
        held[path] = WordBpe(path)
    return held[path]


def encode_documents(
    docs: DataFrame, path: str, text: str = "text", digests: bool = False
) -> DataFrame:
    """One row per document: `doc_id`, `n_tokens`, `ids` (decimal numbers) and `decoded`.

    With `digests` the texts are replaced by their sha256, `ids_sha256` and `decoded_sha256`. A null
    text counts as empty: no tokens, empty decoded text. Repeated rows are each encoded; other
    columns are not read. The file at `path` has to be on every executor.
    """
    names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]

    def shown(value: str) -> str:
        return hashlib.sha256(value.encode()).hexdigest() if digests else value

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for a, b in text_slices(texts):
                ids = bpe.encode(texts[a:b])
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array([i.count(" ") + 1 if i else 0 for i in ids], pa.int64()),
                    pa.array([shown(i) for i in ids], pa.string()),
                    pa.array([shown(bpe.decode(i)) for i in ids], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", *names])

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.col(text).alias("_text"))
    return rows.mapInArrow(
        encode, f"doc_id {kind}, n_tokens bigint, {names[0]} string, {names[1]} string"
    )
