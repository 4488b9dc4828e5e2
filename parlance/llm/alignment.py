"""Alignment of two tokenizers: which tokens of A and B cover the same bytes of a text.

Both tokenizers cut the same bytes (a space and the text). Groups are the
components of the overlap graph: every token points to the farthest-right token
that overlaps it, and doubling all successors at once leads each token to the
last token of its component, which names the group. A batch of texts is one
chain of bytes, so one run of doublings labels all of its groups.

Links are the overlapping pairs of an A and a B token. How often two ids are
linked is counted over the whole corpus and stored as a table by id pair. The
most frequent pairs, a bounded number, are sent to the executors; the others
are joined by key. No hot key takes part in that join, because hot pairs are
the ones that were sent. Sums are whole numbers, so both ways agree.

The files of the tokenizers are read once by the driver and sent; their folder
is a parameter. They are files of fixed size, as is the largest count per B id
(one row per id of the vocabulary).

Defined results: a null or empty text, or one whose token bytes differ from the
text in either tokenizer, has no tokens, zeros, and '' as digest. Repeated rows,
rows without id and ids with several texts are aligned row by row. Very long
texts are encoded whole; memory grows with the longest text. An empty table
gives an empty result. Extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from parlance.llm import words as W
from parlance.llm.storage import stored, text_batches

TOKENIZER_FOLDER = "/opt/tokenizers"
A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"

HOT_PAIRS = 1 << 18  # id pairs sent to the executors, 17 bytes each
BUFFERED_PAIRS = 1 << 20  # id pairs that a counting task holds before it passes them on
ID_BITS = 20  # bits of an id inside a key

# --- Fixed value: how the byte-level tokenizer cuts a text into words ----------
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, " \
          "a array<int>, b array<int>, n array<long>"


class Tokenizers(NamedTuple):
    """Contents of the two tokenizer files."""

    a: bytes
    b: bytes


def read_tokenizers(folder: str = TOKENIZER_FOLDER) -> Tokenizers:
    """Both files, for sending them to the executors."""
    contents = []
    for name in (A_FILE, B_FILE):
        with open(os.path.join(folder, name), "rb") as file:
            contents.append(file.read())
    return Tokenizers(*contents)


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable characters of Latin-1 stand for themselves; the other bytes take
    the code points from 256 on, in order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Tokenizer A: ids of texts, and the bytes of every id.

    The merges of the file are in the order of the ids, which makes the ids the
    ranks of a rank-based encoder; a file where that does not hold is refused.
    """

    def __init__(self, contents: bytes) -> None:
        spec = json.loads(contents)
        alphabet = byte_alphabet()
        special = {token["content"] for token in spec["added_tokens"] if token["special"]}
        vocabulary = {
            bytes(alphabet[c] for c in piece): number
            for piece, number in spec["model"]["vocab"].items() if piece not in special
        }
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [vocabulary[bytes(alphabet[c] for c in left + right)] for left, right in merges]
        if any(x >= y for x, y in zip(made, made[1:])) or len(made) + 256 != len(vocabulary):
            raise ValueError("the merges of the byte-level tokenizer are not in the order of its ids")
        self._encoder = tiktoken.Encoding(
            "byte level", pat_str=WORD_PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for piece, number in vocabulary.items():
            self.pieces[number] = piece

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._encoder.encode_ordinary(text) for text in texts]


class Pieces:
    """Tokenizer B: ids of texts, and the bytes of every id."""

    def __init__(self, contents: bytes) -> None:
        self._encoder = sentencepiece.SentencePieceProcessor(model_proto=contents)
        self.pieces = [self._bytes(number) for number in range(self._encoder.get_piece_size())]

    def _bytes(self, number: int) -> bytes:
        piece = self._encoder.id_to_piece(number)
        if self._encoder.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._encoder.encode(texts, num_threads=1)


_LOADED: dict[str, tuple[ByteLevel, Pieces]] = {}


def load(files: Tokenizers) -> tuple[ByteLevel, Pieces]:
    """Both tokenizers, built once per process."""
    key = hashlib.sha256(files.a + files.b).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteLevel(files.a), Pieces(files.b)
    return _LOADED[key]


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """The last token of each token's component, by pointer jumping.

    Tokens of A come first, then those of B; ends are byte offsets of two ways
    to cut the same bytes. A token points to the farthest-right token that
    overlaps it. Of an A and a B token that end together the A token points to
    the B token, which is where the component ends and points to itself.
    """
    a_start = np.concatenate(([0], a_end[:-1]))
    b_start = np.concatenate(([0], b_end[:-1]))
    own = np.arange(len(b_end))
    of_a = len(a_end) + np.searchsorted(b_start, a_end, "left") - 1
    farthest = np.searchsorted(a_start, b_end, "left") - 1
    of_b = np.where(a_end[farthest] > b_end, farthest, len(a_end) + own)
    successor = np.concatenate((of_a, of_b))
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            return successor
        successor = doubled


def links(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the A and the B token of every overlapping pair, in the order of A."""
    a_start = np.concatenate(([0], a_end[:-1]))
    b_start = np.concatenate(([0], b_end[:-1]))
    first = np.searchsorted(b_end, a_start, "right")
    count = np.searchsorted(b_start, a_end, "left") - first
    before = np.cumsum(count) - count
    a = np.repeat(np.arange(len(a_end)), count)
    return a, np.arange(count.sum()) - np.repeat(before - first, count)


def _decimal(values: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of each value and its separator (0: none) as one byte array, and each value's length in it."""
    width = len(str(int(values.max(initial=0))))
    cells = np.zeros((len(values), width + 1), np.uint8)
    cells[:, width] = separators
    rest = values.copy()
    for column in range(width - 1, -1, -1):
        cells[:, column] = np.where((rest > 0) | (column == width - 1), 0x30 + rest % 10, 0)
        rest //= 10
    shown = cells > 0
    return cells[shown], shown.sum(axis=1)


class Chain(NamedTuple):
    """Tokens of several texts in one chain of bytes: ids, ends, and the text of each token."""

    a: np.ndarray
    b: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray
    a_text: np.ndarray
    b_text: np.ndarray


def chain(texts: list[str | None], a: ByteLevel, b: Pieces) -> Chain:
    """Tokens of the texts that both tokenizers keep whole; the other texts have none."""
    numbers = [i for i, text in enumerate(texts) if text]
    spaced = [" " + texts[i] for i in numbers]
    a_ids, b_ids = a.encode(spaced), b.encode([texts[i] for i in numbers])
    kept = [
        k for k, text in enumerate(spaced)
        if b"".join(map(b.pieces.__getitem__, b_ids[k])) == (whole := text.encode())
        and b"".join(map(a.pieces.__getitem__, a_ids[k])) == whole
    ]

    def flat(ids: list[list[int]], pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        joined = np.fromiter((t for k in kept for t in ids[k]), np.int64, sum(len(ids[k]) for k in kept))
        of = np.repeat(np.array([numbers[k] for k in kept], np.int64), [len(ids[k]) for k in kept])
        return joined, np.cumsum(lengths[joined]), of

    a_flat, a_end, a_text = flat(a_ids, a.pieces)
    b_flat, b_end, b_text = flat(b_ids, b.pieces)
    return Chain(a_flat, b_flat, a_end, b_end, a_text, b_text)


def digests(found: Chain, terminal: np.ndarray, texts: int) -> tuple[list[str], np.ndarray]:
    """SHA-256 of each text's groups in writing, and its number of groups."""
    n_a, n_b = len(found.a), len(found.b)
    last_b = np.unique(terminal) - n_a  # the last B token of each group
    last_a = np.searchsorted(found.a_end, found.b_end[last_b], "left")
    a_group = np.searchsorted(last_a, np.arange(n_a), "left")
    b_group = np.searchsorted(last_b, np.arange(n_b), "left")
    # A group's A tokens stand before its B tokens.
    at_a = np.arange(n_a) + np.concatenate(([0], last_b[:-1] + 1))[a_group] if n_a else np.zeros(0, np.int64)
    at_b = np.arange(n_b) + (last_a + 1)[b_group] if n_b else np.zeros(0, np.int64)
    values = np.empty(n_a + n_b, np.int64)
    values[at_a], values[at_b] = found.a, found.b
    marks = np.full(n_a + n_b, ord(","), np.uint8)
    marks[at_a[last_a]] = ord("|")
    marks[at_b[last_b]] = ord(";")
    of = np.empty(n_a + n_b, np.int64)
    of[at_a], of[at_b] = found.a_text, found.b_text
    end = np.searchsorted(of, np.arange(texts), "right")
    begin = np.searchsorted(of, np.arange(texts), "left")
    marks[end[end > begin] - 1] = 0
    data, sizes = _decimal(values, marks)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    raw = data.tobytes()
    written = [
        hashlib.sha256(raw[offsets[i]:offsets[j]]).hexdigest() if j > i else "" for i, j in zip(begin, end, strict=True)
    ]
    return written, np.bincount(found.b_text[last_b], minlength=texts)


def _linked_pairs(found: Chain, texts: int) -> tuple[np.ndarray, ...]:
    """Distinct id pairs of each text with their links: text borders, A ids, B ids, numbers; and links per text."""
    a, b = links(found.a_end, found.b_end)
    key = (found.a_text[a] << 2 * ID_BITS) | (found.a[a] << ID_BITS) | found.b[b]
    pairs, count = np.unique(key, return_counts=True)
    borders = np.searchsorted(pairs >> 2 * ID_BITS, np.arange(texts + 1), "left")
    low = (1 << ID_BITS) - 1
    return borders, (pairs >> ID_BITS) & low, pairs & low, count, np.bincount(found.a_text[a], minlength=texts)


def _aligner(files: Broadcast):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = load(files.value)
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                texts = piece.column("text").to_pylist()
                found = chain(texts, a, b)
                n = len(texts)
                written, groups = digests(found, terminals(found.a_end, found.b_end), n) \
                    if len(found.a) else ([""] * n, np.zeros(n, np.int64))
                borders, a_ids, b_ids, count, n_links = _linked_pairs(found, n)
                lists = (
                    pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(values, kind))
                    for values, kind in ((a_ids, pa.int32()), (b_ids, pa.int32()), (count, pa.int64()))
                )
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"),
                    pa.array(np.bincount(found.a_text, minlength=n)), pa.array(np.bincount(found.b_text, minlength=n)),
                    pa.array(groups), pa.array(n_links), pa.array(written, pa.string()), *lists,
                ], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "n"])

    return align


def aligned(spark: SparkSession, documents: DataFrame, folder: str = TOKENIZER_FOLDER) -> DataFrame:
    """Per row: tokens, groups, links, digest of the groups, and its linked id pairs with their numbers."""
    text_batches(spark)
    files = spark.sparkContext.broadcast(read_tokenizers(folder))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return texts.mapInArrow(_aligner(files), ALIGNED)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and borders of a list column."""
    borders = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[borders[0]:borders[-1]], borders - borders[0]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id pairs of many rows with their sums, passed on whenever a bounded number is held."""

    def out(pairs: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        low = (1 << ID_BITS) - 1
        return pa.RecordBatch.from_arrays([
            pa.array((pairs >> ID_BITS).astype(np.int32)), pa.array((pairs & low).astype(np.int32)), pa.array(sums),
        ], ["a", "b", "n"])

    pairs, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        a, b, n = (_flat(batch.column(name))[0] for name in ("a", "b", "n"))
        key = (a.astype(np.int64) << ID_BITS) | b
        pairs, at = np.unique(np.concatenate((pairs, key)), return_inverse=True)
        merged = np.zeros(len(pairs), np.int64)
        np.add.at(merged, at, np.concatenate((sums, n)))
        sums = merged
        if len(pairs) > BUFFERED_PAIRS:
            yield out(pairs, sums)
            pairs, sums = pairs[:0], sums[:0]
    yield out(pairs, sums)


def pair_counts(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Corpus-wide links of each id pair: ``a``, ``b``, ``n``, and whether ``n`` is the highest of its ``b``."""
    counts = rows.select("a", "b", "n").mapInArrow(_count, "a int, b int, n long").groupBy("a", "b").agg(
        F.sum("n").alias("n"))
    counts = stored(spark, counts, "alignment-counts")
    # One row per id of the vocabulary of B.
    highest = counts.groupBy("b").agg(F.max("n").alias("most"))
    marked = counts.join(F.broadcast(highest), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    return stored(spark, marked, "alignment-pairs")


class Hot(NamedTuple):
    """The most frequent pairs: keys in order, counts, and whether they are the best of their B id."""

    key: np.ndarray
    n: np.ndarray
    best: np.ndarray


def _eighths(n) -> F.Column:
    """Step of a count on a scale of eighth powers of two."""
    return F.floor(8 * F.log2(n.cast("double"))).cast("int")


def hot_pairs(pairs: DataFrame, limit: int = HOT_PAIRS) -> tuple[Hot, F.Column]:
    """At most ``limit`` pairs with the highest counts, and the condition that the others fulfil.

    The border is a step of a logarithmic scale, found from the number of pairs
    on each step, so nothing is sorted and no more than ``limit`` rows come.
    """
    steps = pairs.groupBy(_eighths(F.col("n")).alias("step")).count().orderBy(F.desc("step")).collect()
    border, held = 1 << 20, 0
    for row in steps:
        held += row["count"]
        if held > limit:
            break
        border = row["step"]
    table = pairs.where(_eighths(F.col("n")) >= border).select(
        ((F.col("a").cast("bigint") * (1 << ID_BITS)) + F.col("b")).alias("key"), "n", "best").toArrow()
    key = table.column("key").to_numpy()
    order = np.argsort(key)
    hot = Hot(key[order], table.column("n").to_numpy()[order], table.column("best").to_numpy()[order])
    return hot, _eighths(F.col("n")) < border


SUMMED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, " \
         "row long, n_best long, count_sum long, a array<int>, b array<int>, n array<long>"


def _per_row(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)))
    return total[borders[1:]] - total[borders[:-1]]


def _summer(hot: Broadcast):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, counts, best = hot.value
        for batch in batches:
            a, borders = _flat(batch.column("a"))
            b, n = _flat(batch.column("b"))[0], _flat(batch.column("n"))[0]
            pair = (a.astype(np.int64) << ID_BITS) | b
            at = np.searchsorted(key, pair)
            sent = np.zeros(len(pair), bool)
            inside = at < len(key)
            sent[inside] = key[at[inside]] == pair[inside]
            at = at[sent]
            links_sent = n[sent]
            value, is_best = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
            value[sent], is_best[sent] = links_sent * counts[at], links_sent * best[at]
            left = pa.array(np.concatenate(([0], np.cumsum(~sent)))[borders], pa.int32())
            kept = [name for name in batch.schema.names if name not in ("a", "b", "n")]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(name) for name in kept),
                pa.array(_per_row(is_best, borders)), pa.array(_per_row(value, borders)),
                *(pa.ListArray.from_arrays(left, pa.array(v[~sent])) for v in (a, b, n)),
            ], [*kept, "n_best", "count_sum", "a", "b", "n"])

    return add


def cross_alignment(
    spark: SparkSession, documents: DataFrame, folder: str = TOKENIZER_FOLDER, sent_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """Per row: token, group and link counts, the digest of its groups, and what the corpus says of its links.

    ``n_best`` counts the links whose id pair is the most frequent one of its B
    id, ties included; ``count_sum`` sums the corpus counts over the links.
    """
    rows = aligned(spark, documents, folder)
    rows = stored(spark, rows.withColumn("row", F.monotonically_increasing_id()), "alignment-rows")
    pairs = pair_counts(spark, rows)
    hot, is_cold = hot_pairs(pairs, sent_pairs)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "row"]
    summed = rows.select(*names, "a", "b", "n").mapInArrow(_summer(spark.sparkContext.broadcast(hot)), SUMMED)
    out = [*names[:5], "n_best", "count_sum", "groups_sha256"]
    cold = pairs.where(is_cold)
    if cold.isEmpty():
        return summed.select(out)
    # What was not sent is joined by id pair; such pairs are rare, so no key of the join is hot.
    summed = stored(spark, summed, "alignment-sums")
    left = summed.select("row", F.explode(F.arrays_zip("a", "b", "n")).alias("link")).select(
        "row", F.col("link.a").alias("a"), F.col("link.b").alias("b"), F.col("link.n").alias("links"))
    rest = left.join(cold, ["a", "b"]).groupBy("row").agg(
        F.sum(F.col("links") * F.col("n")).alias("more_sum"),
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
    )
    return summed.join(rest, "row", "left").select(
        *names[:5], (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256",
    )
