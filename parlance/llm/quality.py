"""Quality classifier: hashed word n-grams, logistic regression, follow the regularised leader.

A text becomes the shares of its hashed words and word pairs; runs of marks
are words, and a word equal to the one before it is replaced by a sign of
repetition. The weights are trained by FTRL-proximal updates (per-coordinate
rates, L1 keeps them sparse), one document after the other, on a sample of at
most ``FIT_ROWS`` labelled rows with the smallest hashes of their ids. The
sample is bounded by that parameter, so one task can hold its sparse rows and
the 2**18 weights can be sent everywhere. Scoring is a sparse dot product per
document: gather the weights of its n-grams and sum them.

Defined results: a null or empty text has no n-grams and gets the score of the
bias. Labels with a null id or value are ignored; of contradicting labels of an
id the smaller counts. Without labelled rows every score is 0.5. Extra columns
do not matter, repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parlance.llm import words as W
from parlance.llm.storage import text_batches

BUCKETS = 1 << 18
FIT_ROWS = 12_000
EPOCHS = 3
# FTRL-proximal: learning rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.01, 0.001
SHARE = 100.0  # scale of the shares of n-grams
AGAIN = np.uint64(0xA0761D6478BD642F)  # a word equal to the one before it

FOLDS = 5
HELD_OUT = 0


def id_fold(doc_id: Column, folds: int) -> Column:
    """Fold of an id: CRC-32 of its text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, rows: int, usable: Column) -> DataFrame:
    """At most ``rows`` labelled texts: those whose ids have the smallest hashes, one text per id.

    The ids are a bounded table, so sending them to the documents is safe; the
    documents are scanned once, and only the texts of these ids are shuffled. Of
    the rows of a repeated id the smallest text counts.
    """
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable)
        .groupBy("doc_id").agg(F.min(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        .select(F.col("doc_id").alias("label_id"), "label")
    )
    texts = documents.where(F.col("text").isNotNull()).select("doc_id", "text")
    return texts.join(F.broadcast(ids), F.col("doc_id") == F.col("label_id")).groupBy("doc_id").agg(
        F.min("text").alias("text"), F.min("label").alias("label"))


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and word pairs of several texts, and where each text's buckets begin."""
    found = W.words_of(data, offsets, W.MARKED)
    value = found.hash.copy()
    same = np.flatnonzero((found.hash[1:] == found.hash[:-1]) & (found.text[1:] == found.text[:-1])) + 1
    value[same] = AGAIN
    pair = np.full(len(value), 0, np.uint64)
    pair[1:] = W.mix(value[:-1] * W.BASE + value[1:])
    begins = np.zeros(len(value) + 1, bool)
    begins[found.first] = True
    pair[begins[:-1]] = W.mix(value[begins[:-1]] + W.ODD)
    both = np.empty(2 * len(value), np.uint64)
    both[0::2], both[1::2] = value, pair
    return (both % np.uint64(BUCKETS)).astype(np.int64), 2 * found.first


class Ftrl:
    """Follow-the-regularised-leader logistic regression on sparse rows."""

    def __init__(self, size: int = BUCKETS) -> None:
        self.z = np.zeros(size + 1)  # the last coordinate is the bias
        self.n = np.zeros(size + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def update(self, at: np.ndarray, x: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / ALPHA * w
        self.n[at] = more


def sparse_rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Coordinates and values of each text of a batch, the bias last."""
    for piece in W.pieces(batch, "text"):
        buckets, first = grams(*W.texts_of(piece.column("text")))
        for a, b in zip(first[:-1], first[1:], strict=True):
            at, count = np.unique(buckets[a:b], return_counts=True)
            yield (np.append(at, BUCKETS).astype(np.int32),
                   np.append(count * (SHARE / max(1, b - a)), 1.0).astype(np.float32))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes over the rows in the given order."""
    model = Ftrl()
    for _ in range(epochs):
        for (at, x), label in zip(rows, labels, strict=True):
            model.update(at, x, float(label))
    return model.weights()


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, labels, keys = [], [], []
    for batch in batches:
        rows += sparse_rows(batch)
        labels += batch.column("label").to_pylist()
        keys += batch.column("doc_id").to_pylist()
    if not rows:
        return
    # Rows arrive in any order; the updates follow the hashes of the ids.
    spread = W.mix(np.array([int(k) & (1 << 63) - 1 for k in keys], np.uint64))
    order = np.lexsort((np.array([len(r[0]) for r in rows]), spread))
    weights = fit([rows[i] for i in order], np.array(labels, float)[order])
    at = np.flatnonzero(weights)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(weights[at], pa.float64())], ["at", "weight"])


def train(spark: SparkSession, documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> np.ndarray:
    """Weights of the classifier, the bias last. Only ids outside the held-out fold are read."""
    usable = id_fold(F.col("doc_id"), FOLDS) != HELD_OUT
    sample = labelled_sample(documents, labels, "quality", fit_rows, usable)
    found = sample.repartition(1).mapInArrow(_train, "at int, weight double").toPandas()
    weights = np.zeros(BUCKETS + 1)
    weights[found["at"].to_numpy(np.int64)] = found["weight"].to_numpy()
    return weights


def scores_of(batch: pa.RecordBatch, weights: np.ndarray) -> np.ndarray:
    """Scores of the texts of a batch."""
    out = []
    for piece in W.pieces(batch, "text"):
        buckets, first = grams(*W.texts_of(piece.column("text")))
        # Summed per text, so that a score does not depend on the texts around it.
        sums = np.add.reduceat(np.append(weights[buckets], 0.0), first[:-1])
        count = np.diff(first)
        out.append(weights[BUCKETS] + SHARE * np.where(count, sums, 0.0) / np.maximum(1, count))
    margin = np.concatenate(out) if out else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores_of(batch, shared.value))], ["doc_id", "score"])

    return score


def quality_scores(spark: SparkSession, documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """Per document: ``doc_id`` and ``score`` between 0 and 1."""
    text_batches(spark)
    shared = spark.sparkContext.broadcast(weights)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return texts.mapInArrow(_scorer(shared), "doc_id bigint, score double")


def _keeper(shared, threshold: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(scores_of(batch, shared.value) >= threshold))

    return keep


def good_documents(spark: SparkSession, documents: DataFrame, weights: np.ndarray, threshold: float) -> DataFrame:
    """Documents that score at least ``threshold``, with all their columns."""
    text_batches(spark)
    return documents.mapInArrow(_keeper(spark.sparkContext.broadcast(weights), threshold), documents.schema)
