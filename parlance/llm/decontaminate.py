"""Benchmark decontamination with an Aho-Corasick automaton over normalised test items.

Texts are normalised byte by byte: A-Z in lower case, every separator a space,
runs of spaces one space. The windows of ten item words, with a space at both
ends, are the patterns of one automaton; each task builds it once and scans
each document once. Hits are positions in the normalised text; they are mapped
to word numbers and, through them, to code points of the original text.

Windows are cut out of the items by tasks, one word after the other, made
distinct, and stored. The automaton is sent to every executor, so its size is
bounded: the pairs of window and item are dealt by hash into groups of about
``automaton_bytes``, so a long item, or a window that very many items share, is
spread over several automata. The driver reads one group at a time, and only to
send it. Each group scans the documents in a job of its own, so a worker holds
one automaton at a time, and the hits of a document are merged. One scan per
group is the price of bounded memory: it grows with the benchmark, not with the
documents.

Defined results: a null or empty text has no words and no hits. An item with
fewer than ten words is one window; without words, or with a null id, it is no
item. Rows repeated in the item table count once; an empty item table hits
nothing. A very long item is one row in one task while its windows are cut, and
a single word must fit a row. Extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import deque
from collections.abc import Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from parlance.llm import words as W
from parlance.llm.storage import stored, text_batches

WINDOW = 10
# Bytes of windows and item ids that one automaton may hold, as the mean of the groups. Each word of an item is in
# ten windows, and the nodes take about ten times the windows.
AUTOMATON_BYTES = 20 << 20
WINDOW_ROWS = 2000  # windows sent out of a task at once

SCHEMA = (
    "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
    "item_ids array<string>, spans array<struct<start:int,end:int>>, word_spans array<struct<start:int,end:int>>, "
    "text_key bigint"
)
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
OUTPUT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
    ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("item_ids", pa.list_(pa.string())),
    ("spans", _SPANS), ("word_spans", _SPANS), ("text_key", pa.int64()),
])

_TABLE = bytes(
    0x20 if not W.ALNUM[b] and not 0x41 <= b <= 0x5A else (b + 0x20 if 0x41 <= b <= 0x5A else b) for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_RUN = re.compile(rb"[^ ]+")


def normalised_words(text: str | None) -> list[bytes]:
    """Words of a text after normalisation, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def windows_of(text: str | None, window: int = WINDOW) -> Iterator[str]:
    """Patterns of one item in their order: its windows of ``window`` words, padded with spaces."""
    last: deque[str] = deque(maxlen=window)
    cut = False
    for found in _RUN.finditer((text or "").encode("utf-8", "surrogatepass").translate(_TABLE)):
        last.append(found[0].decode("latin-1"))
        if len(last) == window:
            cut = True
            yield f" {' '.join(last)} "
    if last and not cut:
        yield f" {' '.join(last)} "


def _cutter(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(batch.column("item_id"), batch.column("text"), strict=True):
                patterns = windows_of(text.as_py(), window)
                while rows := list(islice(patterns, WINDOW_ROWS)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows, pa.string()), pa.array([item_id.as_py()] * len(rows), pa.string())],
                        ["pattern", "item_id"])

    return cut


def _automaton(pairs: list[tuple[str, str]]) -> ahocorasick.Automaton:
    patterns: dict[str, list[str]] = {}
    for pattern, item_id in pairs:
        patterns.setdefault(pattern, []).append(item_id)
    out = ahocorasick.Automaton()
    for pattern, ids in patterns.items():
        # Characters to step back from the last letter, and the number of words.
        out.add_word(pattern, (len(pattern), pattern.count(" ") - 1, tuple(ids)))
    out.make_automaton()
    return out


_BUILT: dict[str, ahocorasick.Automaton] = {}


def _built(pairs: Broadcast, key: str) -> ahocorasick.Automaton:
    """The automaton of a broadcast, built once per Python worker; ``key`` names its group."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = _automaton(pairs.value)
    return _BUILT[key]


def _scan(text: str, automaton: ahocorasick.Automaton) -> tuple[int, np.ndarray | None, set[str]]:
    """Number of words, mask of hit words (None without hits), ids of the items found."""
    found = normalised_words(text)
    if not found or not len(automaton):
        return len(found), None, set()
    padded = (b" " + b" ".join(found) + b" ").decode("latin-1")
    hits = list(automaton.iter(padded))
    if not hits:
        return len(found), None, set()
    spaces = np.flatnonzero(np.frombuffer(padded.encode("latin-1"), np.uint8) == 0x20)
    change = np.zeros(len(found) + 1, np.int64)
    ids: set[str] = set()
    for end, (length, size, item_ids) in hits:
        first = int(np.searchsorted(spaces, end - length + 1))
        change[first] += 1
        change[first + size] -= 1
        ids.update(item_ids)
    return len(found), np.cumsum(change)[:-1] > 0, ids


def _edges(mask: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as word numbers, end exclusive."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _spans(pairs) -> list[dict[str, int]]:
    return [{"start": a, "end": b} for a, b in pairs]


def _row(doc_id, n_words: int, n_hit: int, ids: set[str], word_spans, spans, text_key: int) -> dict:
    listed = sorted(ids)
    return {
        "doc_id": doc_id, "n_words": n_words, "n_hit": n_hit, "n_items": len(listed),
        "items_sha256": hashlib.sha256(",".join(listed).encode()).hexdigest(), "contaminated": n_hit > 0,
        "item_ids": listed, "spans": spans, "word_spans": word_spans, "text_key": text_key,
    }


def _scanner(pairs: Broadcast, key: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _built(pairs, key)
        for batch in batches:
            rows = []
            for doc_id, text, text_key in zip(*(batch.column(c) for c in ("doc_id", "text", "text_key")), strict=True):
                text = text.as_py() or ""
                n_words, mask, ids = _scan(text, automaton)
                runs = [] if mask is None else _edges(mask)
                places = [m.span() for m in _WORD.finditer(text)] if runs else []
                rows.append(_row(
                    doc_id.as_py(), n_words, sum(b - a for a, b in runs), ids, _spans(runs),
                    _spans((places[a][0], places[b - 1][1]) for a, b in runs), text_key.as_py(),
                ))
            yield pa.RecordBatch.from_pylist(rows, schema=OUTPUT)

    return scan


def _union(word_spans: list[dict], spans: list[dict]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Runs of several automata as one list: touching and overlapping runs of words are joined."""
    runs: list[tuple[int, int]] = []
    places: list[tuple[int, int]] = []
    pairs = sorted(((w["start"], w["end"]), (s["start"], s["end"])) for w, s in zip(word_spans, spans, strict=True))
    for (a, b), (c, d) in pairs:
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
            places[-1] = (places[-1][0], max(d, places[-1][1]))
        else:
            runs.append((a, b))
            places.append((c, d))
    return runs, places


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            runs, places = _union(row["word_spans"], row["spans"])
            rows.append(_row(
                row["doc_id"], row["n_words"], sum(b - a for a, b in runs), set(row["item_ids"]), _spans(runs),
                _spans(places), row["text_key"],
            ))
        yield pa.RecordBatch.from_pylist(rows, schema=OUTPUT)


def window_groups(
    spark: SparkSession, items: DataFrame, window: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES,
) -> tuple[DataFrame, int]:
    """Distinct pairs of window and item, stored by ``part``, and the number of parts; at least one."""
    texts = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("string").alias("item_id"), "text")
    pairs = stored(spark, texts.mapInArrow(
        _cutter(window), "pattern string, item_id string").distinct(), "decontaminate-windows")
    size = pairs.agg(F.sum(F.octet_length("pattern") + F.octet_length("item_id"))).first()[0] or 0
    parts = max(1, -(-size // automaton_bytes))
    part = F.pmod(F.xxhash64("pattern", "item_id"), F.lit(parts)).cast("int")
    dealt = pairs.withColumn("part", part)
    return (dealt if parts == 1 else stored(spark, dealt.repartition("part"), "decontaminate-parts")), parts


def _groups(
    spark: SparkSession, items: DataFrame, window: int, automaton_bytes: int,
) -> Iterator[tuple[Broadcast, str]]:
    """One bounded group after the other as a broadcast, and a name for it."""
    text_batches(spark)
    pairs, parts = window_groups(spark, items, window, automaton_bytes)
    for part in range(parts):
        rows = pairs.where(F.col("part") == part).select("pattern", "item_id").toArrow()
        group = list(zip(*(rows.column(c).to_pylist() for c in ("pattern", "item_id")), strict=True))
        yield spark.sparkContext.broadcast(group), uuid.uuid4().hex


def contamination(
    spark: SparkSession, documents: DataFrame, items: DataFrame, window: int = WINDOW,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Per document: words, hit words, items found, and the hit spans of the original text."""
    texts = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    groups = _groups(spark, items, window, automaton_bytes)
    scanned = texts.mapInArrow(_scanner(*next(groups)), SCHEMA)
    following = next(groups, None)
    if following is None:
        return scanned
    # The hits of equal rows are equal, so hits merge by id and text; all rows stay.
    merged = stored(spark, scanned.dropDuplicates(["doc_id", "text_key"]), "decontaminate-hits")
    for group in chain([following], groups):
        scanned = texts.mapInArrow(_scanner(*group), SCHEMA).where("contaminated")
        merged = merged.unionByName(stored(
            spark, scanned.dropDuplicates(["doc_id", "text_key"]), "decontaminate-hits"))
    joined = merged.groupBy("doc_id", "text_key").agg(
        *(F.max(c).alias(c) for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")),
        *(F.flatten(F.collect_list(c)).alias(c) for c in ("item_ids", "spans", "word_spans")),
    )
    names = [field.name for field in OUTPUT]
    keys = texts.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"))
    return joined.select(names).mapInArrow(_merge, SCHEMA).join(
        keys, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key"))
    ).select(names)


def _clean_rows(pairs: Broadcast, key: str):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _built(pairs, key)
        for batch in batches:
            clean = [_scan(text.as_py() or "", automaton)[1] is None for text in batch.column("text")]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return keep


def without_contamination(
    spark: SparkSession, documents: DataFrame, items: DataFrame, window: int = WINDOW,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Documents that no window of an item occurs in, with all their columns."""
    groups = _groups(spark, items, window, automaton_bytes)
    group = next(groups)
    while group is not None:
        documents = documents.mapInArrow(_clean_rows(*group), documents.schema)
        group = next(groups, None)
        if group is not None:
            documents = stored(spark, documents, "decontaminate-kept")
    return documents
