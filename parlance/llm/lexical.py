"""Ranked lexical search by bag deduplication.

For a set of items (queries), documents are reduced to what can matter: how
often they hold each term of the items, and the length norm ``m``. Documents
with the same vector and ``m`` are one class, found by hash and verified on the
values themselves. Every class is scored once. A class keeps as many members
as a ranking can show, the smallest ids first, so a class with a third of all
rows is cut on the map side already; the classes of a ranking are expanded into
their members at the end.

Items are dealt into blocks of a bounded number of terms. The terms of a block
go to the executors, which restrict documents and score classes with arrays. An
item with more terms than a block may hold is answered by joins instead, which
send nothing; the scores are whole numbers and the same either way.

Defined results: a document without terms (null, empty, only marks) is in no
ranking and does not count as a document. Rows without id rank last among equal
scores. Repeated rows are documents of their own. Rows of the items with the
same id are one item with all their terms; the null id is an id. Items without
terms, and empty tables, give no rows. Whole texts count, however long. Extra
columns do not matter.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from parlance.llm import words as W
from parlance.llm.storage import stored, text_batches

TOP = 50
BLOCK_TERMS = 1 << 16  # pairs of item and term in a block
BATCH_CELLS = 1 << 21  # cells of an array while scoring, 8 bytes each

# --- Fixed values: terms, and the scale of weights and norms -------------------
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WEIGHT_SCALE, TF_SCALE, TF_SATURATION, NORM_SCALE, NORM_SHARE = 1000, 1_000_000_000, 1000, 20, 50

# The same terms as byte classes: letters, digits and all bytes outside ASCII, after folding.
TERM_BYTES = W.ALNUM


def terms(text: Column) -> Column:
    """All terms of a text in order; null gives null."""
    folded = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(folded, F.lit(f"({TERM})"), F.lit(1))


def norm(n: Column, documents: int, total: int) -> Column:
    """``m`` of a document with ``n`` terms, in 64-bit integers."""
    share = F.lit(NORM_SHARE).cast("bigint") * n * F.lit(documents).cast("bigint")
    return F.lit(100 - NORM_SHARE).cast("bigint") + F.call_function("div", share, F.lit(total).cast("bigint"))


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """Weight of each term from the number of documents that hold it."""
    return np.floor(WEIGHT_SCALE * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct terms of each item: ``item_id``, ``term``."""
    return items.select("item_id", F.explode(terms(F.col("text"))).alias("term")).distinct()


class Vocabulary(NamedTuple):
    """Terms in the order of their hashes: hashes, bytes, and where each term's bytes begin."""

    hash: np.ndarray
    data: np.ndarray
    begin: np.ndarray


def vocabulary(found: list[str]) -> tuple[Vocabulary, np.ndarray]:
    """The vocabulary of distinct terms, and the number that each given term has in it."""
    data, offsets = W.texts_of(pa.array(found, pa.string()))
    hashes = W.words_of(data, offsets, TERM_BYTES).hash  # a term is one word
    order = np.argsort(hashes, kind="stable")
    ordered, begin = W.texts_of(pa.array([found[i] for i in order], pa.string()))
    number = np.empty(len(found), np.int64)
    number[order] = np.arange(len(found))
    return Vocabulary(hashes[order], ordered, begin), number


def _same_bytes(data: np.ndarray, start: np.ndarray, size: np.ndarray, v: Vocabulary, at: np.ndarray) -> np.ndarray:
    """Whether the words at ``start`` are the terms at ``at``, byte for byte."""
    same = (v.begin[at + 1] - v.begin[at]) == size
    checked = np.flatnonzero(same)
    size = size[checked]
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    equal = data[np.repeat(start[checked], size) + inside] == v.data[np.repeat(v.begin[at[checked]], size) + inside]
    same[checked[np.repeat(np.arange(len(checked)), size)[~equal]]] = False
    return same


def find_terms(data: np.ndarray, found: W.Words, v: Vocabulary) -> np.ndarray:
    """Number of the term that each word is, or -1. Equal hashes are verified on the bytes."""
    number = np.full(len(found.hash), -1, np.int64)
    at = np.searchsorted(v.hash, found.hash, "left")
    open_ = np.arange(len(at))
    while len(open_):  # once, unless two terms have one hash
        open_ = open_[at[open_] < len(v.hash)]
        open_ = open_[v.hash[at[open_]] == found.hash[open_]]
        same = _same_bytes(data, found.start[open_], found.end[open_] - found.start[open_], v, at[open_])
        number[open_[same]] = at[open_[same]]
        open_ = open_[~same]
        at[open_] += 1
    return number


BAGS = "doc_id long, n long, bag binary"


def _bagger(shared: Broadcast):
    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        size = len(v.hash)
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                data, offsets = W.texts_of(piece.column("text"))
                data = W.FOLD[data]
                found = W.words_of(data, offsets, TERM_BYTES)
                number = find_terms(data, found, v)
                known = number >= 0
                key, tf = np.unique(found.text[known] * size + number[known], return_counts=True)
                pairs = np.empty((len(key), 2), "<i4")
                pairs[:, 0], pairs[:, 1] = key % max(size, 1), tf
                borders = np.searchsorted(key, np.arange(len(piece) + 1) * size).astype(np.int32) * 8
                bags = pa.Array.from_buffers(
                    pa.binary(), len(piece), [None, pa.py_buffer(borders), pa.py_buffer(pairs.tobytes())])
                n = np.diff(found.first)
                out = pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(n), bags], ["doc_id", "n", "bag"])
                yield out.filter(pa.array(n > 0))

    return bag


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms and frequencies of a column of bags, and the row of each."""
    if not len(column):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(b"" if data is None else data, np.uint8)[offsets[0]:offsets[-1]]
    pairs = np.frombuffer(raw.tobytes(), "<i4").reshape(-1, 2).astype(np.int64)
    return pairs[:, 0], pairs[:, 1], np.repeat(np.arange(len(column)), np.diff(offsets) // 8)


def _statistics(size: int):
    """Documents that hold each term, and, under the numbers after the last term, documents and their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2, np.int64)
        for batch in batches:
            total[:size] += np.bincount(_pairs(batch.column("bag"))[0], minlength=size)
            total[size] += len(batch)
            total[size + 1] += int(np.sum(batch.column("n").to_numpy()))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["term", "df"])

    return count


class Block(NamedTuple):
    """A block of items for scoring: weights of the terms, the terms of all items in a row, and where each begins."""

    weight: np.ndarray
    term: np.ndarray
    begin: np.ndarray


class _Ranking:
    """The best classes of every item among those seen so far."""

    def __init__(self, items: int, top: int) -> None:
        self.top = top
        self.least = np.zeros(items, np.int64)  # score to reach
        self.item = self.score = self.first = np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)
        self.members = np.zeros(0, object)

    def add(self, scores: np.ndarray, first: np.ndarray, no_id: np.ndarray, members) -> None:
        item, at = np.nonzero((scores > 0) & (scores >= self.least[:, None]))
        if not len(item):
            return
        needed, back = np.unique(at, return_inverse=True)
        values = np.empty(len(needed), object)
        for place, value in enumerate(members.take(pa.array(needed)).to_pylist()):
            values[place] = value
        item = np.concatenate((self.item, item))
        score = np.concatenate((self.score, scores[item[len(self.item):], at]))
        first = np.concatenate((self.first, first[at]))
        no_id = np.concatenate((self.no_id, no_id[at]))
        order = np.lexsort((first, no_id, -score, item))
        begin = np.searchsorted(item[order], np.arange(len(self.least)))
        rank = np.arange(len(order)) - begin[item[order]]
        order, rank = order[rank < self.top], rank[rank < self.top]
        self.members = np.concatenate((self.members, values[back]))[order]
        self.item, self.score, self.first, self.no_id = item[order], score[order], first[order], no_id[order]
        last = rank == self.top - 1
        self.least[self.item[last]] = self.score[last]

    def rows(self) -> pa.RecordBatch:
        """The best classes expanded into their members by id, cut to the documents that can be in a ranking."""
        sizes = np.fromiter(map(len, self.members), np.int64, len(self.members))
        ids = pa.array([i for listed in self.members for i in listed], pa.int64())
        item, score = np.repeat(self.item, sizes), np.repeat(self.score, sizes)
        order = np.lexsort((ids.fill_null(0).to_numpy(), np.asarray(ids.is_null()), -score, item))
        begin = np.searchsorted(item[order], np.arange(len(self.least)))
        order = order[np.arange(len(order)) - begin[item[order]] < self.top]
        return pa.RecordBatch.from_arrays([
            pa.array(item[order], pa.int32()), pa.array(score[order]), ids.take(pa.array(order)),
        ], ["item", "score", "doc_id"])


def class_scores(block: Block, term: np.ndarray, tf: np.ndarray, row: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores of all items for some classes: one row per item, one column per class."""
    parts = np.zeros((len(block.weight), len(m)), np.int64)
    parts[term, row] = block.weight[term] * ((TF_SCALE * tf) // (TF_SATURATION * tf + NORM_SCALE * m[row]))
    return np.add.reduceat(parts[block.term], block.begin, axis=0)


def _scorer(shared: Broadcast, top: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        ranking = _Ranking(len(block.begin), top)
        width = max(1, min(1024, BATCH_CELLS // max(len(block.term), len(block.weight))))
        for batch in batches:
            for start in range(0, len(batch), width):
                part = batch.slice(start, width)
                first = part.column("first")
                ranking.add(
                    class_scores(block, *_pairs(part.column("bag")), part.column("m").to_numpy()),
                    first.fill_null(0).to_numpy(), np.asarray(first.is_null()), part.column("members"),
                )
        yield ranking.rows()

    return score


def classes(bags: DataFrame, top: int) -> DataFrame:
    """One row per distinct bag and ``m``: ``bag``, ``m``, its first ``top`` members by id, and the first of them.

    The hash deals the rows, the values decide. Ranks are cut before the rows
    are dealt, so no more than ``top`` rows of a class leave a task.
    """
    same = ["key", "bag", "m"]
    members = Window.partitionBy(*same).orderBy(F.asc_nulls_last("doc_id"))
    ranked = bags.withColumn("key", F.xxhash64("bag", "m")).withColumn("place", F.row_number().over(members))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "doc_id"))), lambda x: x["doc_id"])
    return ranked.where(F.col("place") <= top).groupBy(*same).agg(listed.alias("members")).select(
        "bag", "m", "members", F.get("members", F.lit(0)).alias("first"))


def _best(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` documents of each item: highest score, then smallest id."""
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "item_id", "rank", "doc_id", "score")


def _block_search(spark: SparkSession, documents: DataFrame, queries: DataFrame, top: int) -> DataFrame:
    """Rankings of the items of one block, whose terms are ``queries``."""
    rows = queries.orderBy("item_id", "term").collect()
    ids = list(dict.fromkeys(r["item_id"] for r in rows))
    v, number = vocabulary(distinct := sorted({r["term"] for r in rows}))
    of = dict(zip(distinct, number.tolist(), strict=True))
    bags = stored(spark, documents.mapInArrow(_bagger(spark.sparkContext.broadcast(v)), BAGS), "lexical-bags")
    size = len(distinct)
    counts = np.zeros(size + 2, np.int64)
    for r in bags.mapInArrow(_statistics(size), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        counts[r["term"]] = r["df"]
    held, total = int(counts[size]), int(counts[size + 1])
    begin = np.array([i for i, r in enumerate(rows) if not i or r["item_id"] != rows[i - 1]["item_id"]])
    block = Block(weights(counts[:size], held), np.array([of[r["term"]] for r in rows]), begin)
    normed = bags.where(F.octet_length("bag") > 0).select(
        "doc_id", "bag", norm(F.col("n"), held, max(total, 1)).alias("m"))
    scored = classes(normed, top).mapInArrow(
        _scorer(spark.sparkContext.broadcast(block), top), "item int, score long, doc_id long")
    names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {queries.schema['item_id'].dataType.simpleString()}")
    return _best(scored.join(F.broadcast(names), "item").select("item_id", "doc_id", "score"), top)


def _join_search(spark: SparkSession, documents: DataFrame, queries: DataFrame, top: int) -> DataFrame:
    """Rankings of items with any number of terms: frequencies joined with the terms of the items by key."""
    held = documents.select("doc_id", F.monotonically_increasing_id().alias("row"), terms(F.col("text")).alias("t"))
    counted = held.select("row", "doc_id", F.size("t").cast("bigint").alias("n"), F.explode("t").alias("term")).groupBy(
        "row", "doc_id", "n", "term").agg(F.count("*").alias("tf"))
    counted = stored(spark, counted, "lexical-frequencies")
    n, total = counted.agg(F.countDistinct("row"), F.coalesce(F.sum("tf"), F.lit(0))).collect()[0]
    weight = F.floor(WEIGHT_SCALE * F.log((F.lit(2.0 * n + 2)) / (2 * F.col("df") + 1))).cast("bigint")
    weighted = counted.groupBy("term").agg(F.count("*").alias("df")).select("term", weight.alias("w"))
    asked = queries.join(weighted, "term")
    part = F.call_function(
        "div", F.lit(TF_SCALE).cast("bigint") * F.col("tf"),
        TF_SATURATION * F.col("tf") + NORM_SCALE * norm(F.col("n"), n, max(total, 1)))
    scores = counted.join(asked, "term").groupBy("item_id", "row", "doc_id").agg(
        F.sum(F.col("w") * part).alias("score")).where("score > 0")
    return _best(scores, top)


def blocks(sizes: DataFrame, block_terms: int) -> int:
    """Number of blocks that items are dealt into by hash so that none has more than ``block_terms`` terms."""
    number = 1
    while True:
        block = F.pmod(F.xxhash64("item_id"), F.lit(number))
        largest = sizes.groupBy(block.alias("block")).agg(F.sum("n").alias("n")).agg(F.max("n")).collect()[0][0]
        if (largest or 0) <= block_terms:
            return number
        number *= 2


def ranked_search(
    spark: SparkSession, documents: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The ``top`` documents of each item with a score above 0: ``item_id``, ``rank``, ``doc_id``, ``score``."""
    text_batches(spark)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    queries = stored(spark, item_terms(items), "lexical-items")
    sizes = stored(spark, queries.groupBy("item_id").agg(F.count("*").alias("n")), "lexical-sizes")
    # Two items may fall into one block by their hashes; half a block at most leaves room for dealing them.
    small = sizes.where(F.col("n") <= block_terms // 2)
    number = blocks(small, block_terms)
    parts = []
    if not small.isEmpty():
        asked = queries.join(small.select(F.col("item_id").alias("small_id")), F.col("item_id").eqNullSafe(F.col("small_id")))
        for block in range(number):
            chosen = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(number)) == block).select("item_id", "term")
            if number == 1 or not chosen.isEmpty():
                parts.append(_block_search(spark, texts, chosen, top))
    large = sizes.where(F.col("n") > block_terms // 2).select(F.col("item_id").alias("large_id"))
    if not large.isEmpty():
        chosen = queries.join(large, F.col("item_id").eqNullSafe(F.col("large_id"))).select("item_id", "term")
        parts.append(_join_search(spark, texts, chosen, top))
    if not parts:
        return _best(queries.select("item_id", F.lit(None).cast("bigint").alias("doc_id"),
                                    F.lit(0).cast("bigint").alias("score")).where(F.lit(False)), top)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
