"""Repeated passages by a sparse suffix array.

Of all suffixes of all texts only those at minimisers are retained: in every
window of ``PASSAGE`` words, the suffix that begins with the smallest hashed run
of ``SEED`` words. The choice depends on the content alone, so equal passages
retain suffixes at equal places, one in about twenty words.

A retained suffix stands for its stretch: the passage-long windows whose
minimiser it is. Suffixes are not sorted but grouped by the hash of their
stretch, whatever document they come from; a stretch found in two documents is
repeated as a whole. A stretch that differs may still share its inner part with
another one that begins with the same seed. For those only, the hashes of all
windows of the stretch are grouped over the whole table, in place of extending a
match word by word to the left and to the right of the seed. The result is exact: a word is repeated if and
only if it lies in ``PASSAGE`` consecutive words that another document has too.

Groups of equal suffixes are reduced with partial sums to their first and last
document and never gathered, so a passage in a third of all documents is no
larger a group than one in two of them.

Defined results: words are runs of characters other than space and the control
characters tab to carriage return, with A-Z in lower case. Documents are the
distinct pairs of id and text: rows repeated exactly are one document, and each
gets its result. Null texts are empty; texts shorter than a passage repeat
nothing. Null ids take part. Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from parlance.llm import words as W
from parlance.llm.storage import stored

PASSAGE = 50
SEED = 10

SUFFIXES = "doc bigint, doc_id bigint, seed bigint, stretch bigint, first int, last int, n_words int"
_SUFFIXES = pa.schema([
    ("doc", pa.int64()), ("doc_id", pa.int64()), ("seed", pa.int64()), ("stretch", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
    ("n_words", pa.int32()),
])


def minimisers(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value, the leftmost of equals, in every window of ``width`` values."""
    at = np.arange(len(values))
    span = 1
    while span < width:
        step = min(span, width - span)
        left, right = at[:len(at) - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        span += step
    return at


def _stretches(found: W.Words, passage: int, seed: int) -> tuple[np.ndarray, ...]:
    """Text, seed hash, stretch hash, first and last window (word numbers of the batch) of retained suffixes."""
    n = len(found.hash)
    if n < passage:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    seeds = W.runs_hash(found.hash, seed)
    at = minimisers(seeds, passage - seed + 1)
    valid = found.text[:n - passage + 1] == found.text[passage - 1:]
    windows = np.flatnonzero(valid)
    if not len(windows):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    text, place = found.text[windows], at[windows]
    begins = np.ones(len(windows), bool)
    begins[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(begins)
    tail = np.append(head[1:], len(windows)) - 1
    first, last = windows[head], windows[tail]
    up, down = W.powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(found.hash * up[:n], out=total[1:])
    stop = last + passage
    stretch = W.mix((total[stop] - total[first]) * down[first] + (stop - first).astype(np.uint64) * W.ODD)
    return text[head], seeds[place[head]], stretch, first, last


def _suffixes(passage: int, seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                data, offsets = W.texts_of(piece.column("text"))
                found = W.words_of(W.FOLD[data], offsets, W.SPACED)
                docs = piece.column("doc").to_numpy()
                count = len(docs)
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs), piece.column("doc_id"),
                    *(pa.nulls(count, kind) for kind in (pa.int64(), pa.int64(), pa.int32(), pa.int32())),
                    pa.array(np.diff(found.first).astype(np.int32)),
                ], schema=_SUFFIXES)
                text, begin, stretch, first, last = _stretches(found, passage, seed)
                if len(text):
                    start = found.first[text]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(docs[text]), pa.nulls(len(text), pa.int64()), W.as_long(begin), W.as_long(stretch),
                        pa.array((first - start).astype(np.int32)), pa.array((last - start).astype(np.int32)),
                        pa.nulls(len(text), pa.int32()),
                    ], schema=_SUFFIXES)

    return rows


WINDOWS = "doc bigint, place int, hash bigint, low bigint, high bigint"
_WINDOWS = pa.schema([
    ("doc", pa.int64()), ("place", pa.int32()), ("hash", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
])


def _windows(passage: int):
    """Hashes of all windows of the listed stretches of each text."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                data, offsets = W.texts_of(piece.column("text"))
                found = W.words_of(W.FOLD[data], offsets, W.SPACED)
                hashes = W.runs_hash(found.hash, passage)
                lists = piece.column("stretches")
                flat = lists.flatten()
                text = np.repeat(np.arange(len(piece)), lists.value_lengths().to_numpy())
                first, last, low, high = (flat.field(k).to_numpy() for k in range(4))
                length = (last - first + 1).astype(np.int64)
                which = np.repeat(np.arange(len(first)), length)
                place = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(length) - length, length)
                at = found.first[text[which]] + place
                yield pa.RecordBatch.from_arrays([
                    pa.array(piece.column("doc").to_numpy()[text[which]]), pa.array(place.astype(np.int32)),
                    W.as_long(hashes[at]), pa.array(low[which]), pa.array(high[which]),
                ], schema=_WINDOWS)

    return rows


def _named(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
    ).select("doc_id", F.xxhash64("doc_id", "text").alias("doc"), "text")


def _covered(passage: int):
    """Repeated words and the passages of each document, from the places of its repeated windows."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans = [], []
            for ranges in batch.column("ranges"):
                merged: list[list[int]] = []
                for a, b in sorted((r["first"].as_py(), r["last"].as_py() + passage) for r in ranges):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                counts.append(sum(b - a for a, b in merged))
                spans.append([{"start": a, "end": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), pa.array(counts, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ], ["doc", "n_repeated", "passages"])

    return rows


def repeated_passages(
    spark: SparkSession, documents: DataFrame, passage: int = PASSAGE, seed: int = SEED,
) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_repeated`` words, and the ``passages`` as word numbers."""
    named = _named(documents)
    rows = stored(spark, named.mapInArrow(_suffixes(passage, seed), SUFFIXES), "suffixes")
    suffixes = rows.where("stretch is not null").drop("n_words", "doc_id")
    # Equal stretches are neighbours; of each, its first and last document.
    groups = stored(spark, suffixes.groupBy("stretch").agg(
        F.first("seed").alias("seed"), F.min(F.struct("doc", "first", "last")).alias("one"),
        F.max("doc").alias("high")), "suffixes-groups")
    repeated = F.col("one.doc") != F.col("high")
    # Seeds of two documents that have a stretch which is not repeated as a whole.
    seeds = groups.groupBy("seed").agg(
        F.min("one.doc").alias("low"), F.max("high").alias("top"), F.max(~repeated).alias("partial"))
    seeds = seeds.where("low <> top and partial").select("seed")
    extended = groups.join(seeds, "seed", "left_semi")
    whole = suffixes.join(groups.where(repeated).select("stretch"), "stretch", "left_semi")
    # Of a stretch that is repeated, one place serves to compare others with it.
    known = extended.where(repeated).select(
        F.col("one.doc").alias("doc"),
        F.struct(F.col("one.first").alias("first"), F.col("one.last").alias("last"),
                 F.col("one.doc").alias("low"), "high").alias("s"))
    # A document may hold a stretch several times; all of its places count.
    open_places = suffixes.join(extended.where(~repeated).select("stretch"), "stretch", "left_semi").select(
        "doc", F.struct("first", "last", F.col("doc").alias("low"), F.col("doc").alias("high")).alias("s"))
    wanted = known.unionByName(open_places).groupBy("doc").agg(F.collect_set("s").alias("stretches"))
    texts = named.select("doc", "text").join(wanted, "doc")
    windows = stored(spark, texts.mapInArrow(_windows(passage), WINDOWS), "suffixes-windows")
    shared = windows.groupBy("hash").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high")
    partly = windows.join(shared.select("hash"), "hash", "left_semi").select(
        "doc", F.col("place").alias("first"), F.col("place").alias("last"))
    ranges = whole.select("doc", "first", "last").unionByName(partly)
    found = ranges.groupBy("doc").agg(F.collect_set(F.struct("first", "last")).alias("ranges")).mapInArrow(
        _covered(passage), "doc bigint, n_repeated bigint, passages array<struct<start:int,end:int>>")
    sizes = rows.where("stretch is null").select("doc", "doc_id", "n_words")
    return sizes.join(found, "doc", "left").select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_repeated", F.lit(0)).cast("bigint").alias("n_repeated"),
        F.coalesce("passages", F.array().cast("array<struct<start:int,end:int>>")).alias("passages"),
    )
