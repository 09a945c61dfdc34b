"""Token ids in files: canonical length-limited Huffman coding, decoded in independent blocks.

Code lengths come from the counts of the ids over the whole corpus (package-merge, at most
`MOST_BITS` bits); codes are canonical, so the lengths are all a reader needs. Each document is coded
in blocks of `BLOCK` ids. The bit offset of every block is kept as a checkpoint, and decoding reads
all blocks of a segment side by side, one table look-up per id.

A file is a Parquet file of segments in ascending id of their documents, and the files (`part`) are
in ascending order as well. One segment has about `SEGMENT` ids:

    part, segment, n_tokens, doc_ids, counts (ids per document), blocks (bits of each block, in
    order), data (documents one after another, each from a whole byte on)

The lengths are in a file of their own, next to the segments.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm.common import stored, text_slices, worker_cache
from tapeline.streaming.runs import work_folder

MOST_BITS = 16
BLOCK = 128
SEGMENT = 250_000
PART_DOCS = 8_000
# Pieces that a worker remembers; those met in the last half of them at least.
REMEMBERED = 1_500_000

# Fixed value: the pattern by which a byte-level tokenizer of this kind cuts a text.
_CUT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# The same for texts of characters up to U+024F, where letters and digits can be listed; several
# times as fast. Python counts four control characters as white space, so they are left out here.
_LETTERS, _DIGITS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_LATIN = re.compile(r"[\x00-\x1b\x20-ɏ]*").fullmatch
_LATIN_CUT = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^\s{_LETTERS}{_DIGITS}]+|\s+(?!\S)|\s"
).findall


def _byte_chars() -> dict[int, str]:
    """The character that a byte-level vocabulary writes each byte with: its own in Latin-1 if that
    can be seen, else the next one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in seen]
    return {byte: chr(256 + n) for n, byte in enumerate(hidden)}


_BYTE_CHARS = _byte_chars()


class ByteBpe:
    """The library's tokenizer, asked once for every piece of a text that a worker has not seen."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.cut = regex.compile(_CUT).findall
        with open(path, encoding="utf-8") as file:
            special = [added["content"] for added in json.load(file)["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)").search
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, new: set[str]) -> None:
        """Ids of pieces, from what was known before or from the library's model."""
        for piece in new & self.older.keys():
            self.pieces[piece] = self.older[piece]
            new.discard(piece)
        tokenize, pieces = self.model.tokenize, self.pieces
        for piece in new:
            found = tokenize(piece.encode().decode("latin-1").translate(_BYTE_CHARS))
            pieces[piece] = array("H", [token.id for token in found]).tobytes()

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        """Ids of each text as little-endian 16-bit numbers, and the end id."""
        if len(self.pieces) > REMEMBERED // 2:
            self.pieces, self.older = {}, self.pieces
        # Texts with a special token in them go to the library whole.
        whole = [self.special(text) is not None for text in texts]
        split = [
            [] if w else (_LATIN_CUT if _LATIN(t) else self.cut)(t)
            for t, w in zip(texts, whole, strict=True)
        ]
        known = self.pieces
        self.learn(set().union(*split).difference(known))
        ids_of, tail = known.__getitem__, np.uint16(end).tobytes()
        coded = []
        for text, w, pieces in zip(texts, whole, split, strict=True):
            if w:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                coded.append(np.array(ids, np.uint16).tobytes() + tail)
            else:
                coded.append(b"".join(map(ids_of, pieces)) + tail)
        return coded


def token_ids(docs: DataFrame, path: str, end: int, text: str = "text") -> DataFrame:
    """`doc_id`, `n_tokens` and `ids` of every text, null as empty, with the end id.

    Each task adds one row whose `counts` has how often each id came up, for the code; that column
    is null in the rows of documents.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = worker_cache("byte_bpe")
        bpe = held.get(path) or held.setdefault(path, ByteBpe(path))
        names = ["doc_id", "n_tokens", "ids", "counts"]
        seen = np.zeros(1 << 16, np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in text_slices(texts):
                ids = bpe.encode(texts[a:b], end)
                seen += np.bincount(np.frombuffer(b"".join(ids), np.uint16), minlength=len(seen))
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array([len(i) // 2 for i in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.nulls(b - a, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)
        columns = [
            pa.nulls(1, pa.int64()),
            pa.nulls(1, pa.int64()),
            pa.nulls(1, pa.binary()),
            pa.array([seen.tobytes()], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col(text).alias("_text"))
    return rows.mapInArrow(encode, "doc_id bigint, n_tokens bigint, ids binary, counts binary")


def id_counts(tokens: DataFrame) -> dict[int, int]:
    """How often each id occurs, over all documents. As many as the vocabulary has ids."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for counts in batch.column(0):
                seen += np.frombuffer(counts.as_buffer(), np.int64)
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int32)), pa.array(seen[found])], ["id", "n"]
        )

    rows = tokens.where("counts IS NOT NULL").select("counts").mapInArrow(count, "id int, n bigint")
    return {r["id"]: r["n"] for r in rows.groupBy("id").agg(F.sum("n").alias("n")).collect()}


def code_lengths(counts: dict[int, int], most_bits: int = MOST_BITS) -> dict[int, int]:
    """Length-limited Huffman code lengths by package-merge: optimal under the limit."""
    if len(counts) == 1:
        return dict.fromkeys(counts, 1)
    leaves = sorted((n, (i,)) for i, n in counts.items())
    # A level's chosen leaves are always its rarest, so their number is all that is kept.
    weights = np.array([n for n, _ in leaves], np.float64)
    levels = []
    packages = np.empty(0)
    for _ in range(most_bits):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order < len(weights))
        merged = merged[order]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    lengths = np.zeros(len(weights), np.int64)
    take = 2 * len(weights) - 2
    for is_leaf in reversed(levels):
        taken = int(is_leaf[:take].sum())
        lengths[:taken] += 1
        take = 2 * (take - taken)
    return {i: int(length) for (_, (i,)), length in zip(leaves, lengths, strict=True)}


class Code:
    """Canonical codes from lengths: shorter first, then by id."""

    def __init__(self, lengths: dict[int, int]):
        order = sorted(lengths, key=lambda i: (lengths[i], i))
        self.bits = np.zeros(1 << 16, np.uint64)
        self.length = np.zeros(1 << 16, np.int64)
        self.table_id = np.zeros(1 << MOST_BITS, np.uint16)
        self.table_length = np.zeros(1 << MOST_BITS, np.uint8)
        code = previous = 0
        for i in order:
            length = lengths[i]
            code <<= length - previous
            previous = length
            self.bits[i], self.length[i] = code, length
            first = code << (MOST_BITS - length)
            self.table_id[first : first + (1 << (MOST_BITS - length))] = i
            self.table_length[first : first + (1 << (MOST_BITS - length))] = length
            code += 1

    def encode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Coded documents, each from a whole byte on, and the bits of each block."""
        lengths = self.length[ids]
        bits = np.concatenate([[0], np.cumsum(lengths)])
        first = np.concatenate([[0], np.cumsum(counts)])
        begins = np.concatenate([[0], np.cumsum((np.diff(bits[first]) + 7) // 8)])
        start = bits[:-1] + np.repeat(8 * begins[:-1] - bits[first[:-1]], counts)
        word, shift = start >> 6, 64 - (start & 63) - lengths
        code = self.bits[ids]
        high = np.where(
            shift >= 0,
            code << np.maximum(shift, 0).astype(np.uint64),
            code >> np.maximum(-shift, 0).astype(np.uint64),
        )
        out = np.zeros(int(begins[-1]) // 8 + 2, np.uint64)
        at = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[at]] = np.bitwise_or.reduceat(high, at)
        over = np.flatnonzero(shift < 0)
        out[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
        edges = _block_edges(first, counts)
        return out.astype(">u8").tobytes()[: begins[-1]], np.diff(bits[edges])

    def decode(self, data: bytes, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Ids of blocks, given the bit at which each begins and its number of ids."""
        padded = np.frombuffer(data + bytes(8), np.uint8)
        # Longest first, so that the blocks still open are a prefix.
        order = np.argsort(-sizes, kind="stable")
        at, left = begin[order].astype(np.int64), sizes[order]
        where = np.concatenate([[0], np.cumsum(sizes)])[:-1][order]
        out = np.empty(int(sizes.sum()), np.uint16)
        for step in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(-left, -step, side="left"))
            at, where = at[:n], where[:n]
            byte = at >> 3
            window = (
                padded[byte].astype(np.uint32) << 16
                | padded[byte + 1].astype(np.uint32) << 8
                | padded[byte + 2]
            )
            seen = (window >> (8 - (at & 7)).astype(np.uint32)) & 0xFFFF
            out[where + step] = self.table_id[seen]
            at = at + self.table_length[seen]
        return out


def _block_edges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Where blocks begin among the ids of consecutive documents, and the end."""
    n = -(-counts // BLOCK)
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return np.append(np.repeat(first[:-1], n) + inside * BLOCK, first[-1])


_SEGMENTS = (
    "part int, segment int, n_tokens bigint, doc_ids array<bigint>, counts binary, blocks binary,"
    " data binary"
)


def write_token_files(tokens: DataFrame, folder: str) -> None:
    """Code the ids of all documents and write them in ascending `doc_id` (nulls first).

    `tokens` is read twice and should be stored. Only the code lengths, one per id of the
    vocabulary, pass the driver.
    """
    spark = tokens.sparkSession
    lengths = code_lengths(id_counts(tokens))
    lengths_table = spark.createDataFrame(sorted(lengths.items()), "id int, bits int")
    lengths_table.coalesce(1).write.parquet(f"{folder}/lengths")
    sent = spark.sparkContext.broadcast(lengths)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Code(sent.value)
        held, size, number = [], 0, 0
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                held.append(row)
                size += row[2]
                if size >= SEGMENT:
                    yield _segment(coder, number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield _segment(coder, number, held)

    tokens = tokens.where("counts IS NULL")
    parts = max(1, -(-tokens.count() // PART_DOCS))
    (
        tokens.repartitionByRange(parts, "doc_id", "n_tokens")
        .sortWithinPartitions("doc_id", "n_tokens", "ids")
        .select(F.spark_partition_id().alias("part"), "doc_id", "n_tokens", "ids")
        .mapInArrow(segments, _SEGMENTS)
        .write.option("compression", "uncompressed")
        .parquet(f"{folder}/segments")
    )


def _segment(coder: Code, number: int, rows: list[tuple]) -> pa.RecordBatch:
    parts, doc_ids, sizes, ids = zip(*rows, strict=True)
    counts = np.array(sizes, "<i8")
    data, blocks = coder.encode(np.frombuffer(b"".join(ids), np.uint16), counts)
    columns = [
        pa.array(parts[:1], pa.int32()),
        pa.array([number], pa.int32()),
        pa.array([int(counts.sum())], pa.int64()),
        pa.array([doc_ids], pa.list_(pa.int64())),
        pa.array([counts.tobytes()], pa.binary()),
        pa.array([blocks.astype("<u2").tobytes()], pa.binary()),
        pa.array([data], pa.binary()),
    ]
    names = ["part", "segment", "n_tokens", "doc_ids", "counts", "blocks", "data"]
    return pa.RecordBatch.from_arrays(columns, names)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the files: `doc_id`, `start` (ids of all before it), `n_tokens`, `ids_crc32`."""
    rows = spark.read.parquet(f"{folder}/lengths").collect()
    sent = spark.sparkContext.broadcast({r["id"]: r["bits"] for r in rows})
    segments = spark.read.schema(_SEGMENTS).parquet(f"{folder}/segments")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Code(sent.value)
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], "<i8")
                ids = _decode_segment(coder, row["data"], counts, row["blocks"])
                first = np.concatenate([[0], np.cumsum(counts)])
                crc = [
                    zlib.crc32(ids[a:b].astype("<u4").tobytes())
                    for a, b in zip(first, first[1:], strict=False)
                ]
                columns = [
                    pa.array([row["part"]] * len(counts), pa.int32()),
                    pa.array([row["segment"]] * len(counts), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(first[:-1], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                names = ["part", "segment", "doc_id", "inside", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns, names)

    decoded = segments.select("part", "segment", "doc_ids", "counts", "blocks", "data").mapInArrow(
        decode,
        "part int, segment int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint",
    )
    # Offsets: within each part over its segments, and over the parts.
    sizes = segments.select("part", "segment", F.col("n_tokens").alias("size"))
    parts = sizes.groupBy("part").agg(F.sum("size").alias("size"))
    before = "sum(size) OVER ({} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    parts = parts.select("part", F.expr(before.format("ORDER BY part")).alias("parts_before"))
    within = sizes.select(
        "part",
        "segment",
        F.expr(before.format("PARTITION BY part ORDER BY segment")).alias("segments_before"),
    )
    zero = F.lit(0).cast("bigint")
    start = (
        F.coalesce("parts_before", zero) + F.coalesce("segments_before", zero) + F.col("inside")
    )
    return (
        decoded.join(within.join(parts, "part"), ["part", "segment"])
        .select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")
    )


def _decode_segment(coder: Code, data: bytes, counts: np.ndarray, blocks: bytes) -> np.ndarray:
    bits = np.frombuffer(blocks, "<u2").astype(np.int64)
    n = -(-counts // BLOCK)
    first = np.concatenate([[0], np.cumsum(n)])
    ends = np.concatenate([[0], np.cumsum(bits)])
    of_doc = ends[first]
    begins = np.concatenate([[0], np.cumsum((np.diff(of_doc) + 7) // 8)])[:-1]
    checkpoints = ends[:-1] + np.repeat(8 * begins - of_doc[:-1], n)
    sizes = np.full(int(n.sum()), BLOCK, np.int64)
    last = first[1:][n > 0] - 1
    sizes[last] = (counts - (n - 1) * BLOCK)[n > 0]
    return coder.decode(data, checkpoints, sizes)


def token_files(
    spark: SparkSession, docs: DataFrame, path: str, end: int, text: str = "text"
) -> DataFrame:
    """Encode, write, read back: see `read_token_files`.

    Null texts count as empty and have the end id alone. Null ids come first. Rows that share an id
    come in the order of their number of ids, then of the ids. An empty table gives empty
    files and no rows.
    """
    tokens = stored(token_ids(docs, path, end, text), "token-ids", compression="zstd")
    folder = work_folder(spark, "token-files")
    write_token_files(tokens, folder)
    return read_token_files(spark, folder)
