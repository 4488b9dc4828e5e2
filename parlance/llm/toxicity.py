"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models are counted, one over toxic and one over ordinary labelled
texts. Each word is judged by the logarithm of the ratio of its probabilities
in both; a text by the sum over its words, normalised by its length. The
models of a class are interpolated and discounted:

    P(w | v)  bigram counts, backing off to
    P(w)      the number of different words before w, backing off to
    P(s)      the same for s, the first four bytes of w, times the share of w
              among the words that begin with s, which both classes have in
              common: a rare expression is judged by its relatives.

The number of different words before w grows more slowly than the text it is
counted in, so frequent words would look likelier in the class with less text.
For the larger class it is therefore the number that is expected in as many of
its words as the smaller one has: a pair seen n times counts 1 - (1 - f)^n for
the share f of the larger class.

An expression keeps a ratio of its own only if its counts in the two classes
contradict its backoff (a G-test above ``MIN_G``); otherwise the backoff judges
it, and in the end the classes share one probability and the ratio is zero. This
keeps the chance differences of many ordinary words out of the sum. Neither the
size of a ratio nor the number of ratios is limited.

The ratios are kept in a stored table, each as its step from the ratio of its
backoff, so the sum over a text is a sum over its beginnings, words and bigrams,
in any order. Steps are whole multiples of 1 / ``SCALE``: sums are exact. The
``SENT_ROWS`` most frequent expressions are sent to the executors; beyond them
the n-grams of the texts are joined with the table by key. Both give the same
sums.

Counting covers every labelled row of the training folds; only the words' names
are shortened, to 32-bit hashes. A logistic curve from normalised ratios to the
chance of label 1 is fitted on at most ``CALIBRATION_ROWS`` of these rows. It is
fitted with ratios of the counts without those rows, so no text judges itself;
texts are scored with the ratios of all counts.

Defined results: a null or empty text has no words and gets the value of the
curve there. Labels with a null id or value are ignored, and an id with
contradicting labels is toxic. Without labelled rows of both classes every score
is 0.5. Repeated rows are scored alike; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parlance.llm import words as W
from parlance.llm.storage import one_row, stored

DISCOUNT = 0.75
MIN_G = 15.0
SCALE = 1 << 24
# Up to so many ratios, the most frequent expressions, are sent to the executors; more are joined with a shuffle.
SENT_ROWS = 1_000_000
STEM_BYTES = 4
CALIBRATION_ROWS = 20_000
CALIBRATION_SLICE = 8  # the curve is fitted on one of so many training rows
# Up to so many labelled ids are sent to the documents; more are joined with a shuffle.
SENT_IDS = 2_000_000
TEXT_START = np.uint64(0)
# Words whose counts a task sums up before it hands them on, and keys that it hands on at once.
BLOCK_WORDS = 3_000_000
BATCH_KEYS = 1 << 16


class Model(NamedTuple):
    """Steps of the log ratios by sorted keys, the stored table of the steps that are not sent, and the curve."""

    pairs: np.ndarray
    pair_step: np.ndarray
    words: np.ndarray
    word_step: np.ndarray
    stems: np.ndarray
    stem_step: np.ndarray
    rest: DataFrame | None
    curve: np.ndarray


def named(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word of several texts: the word before, the word and its beginning, as 32-bit names; first word per text."""
    folded = W.FOLD[data]
    found = W.words_of(folded, offsets, W.ALNUM)
    low = np.uint64(0xFFFFFFFF)
    word = found.hash & low
    before = np.full(len(word), TEXT_START, np.uint64)
    before[1:] = word[:-1]
    before[found.first[:-1][np.diff(found.first) > 0]] = TEXT_START
    length = found.end - found.start
    stem = np.zeros(len(word), np.uint64)
    for k in range(STEM_BYTES):
        stem = stem * np.uint64(256) + np.where(k < length, folded[np.minimum(found.start + k, len(folded) - 1)], 0)
    return before, word, W.mix(stem + W.ODD) & low, found.first


def _summed(kind: int, keys: np.ndarray, group: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Keys of one kind with their counts in toxic and in ordinary texts, and those in texts held for the curve.

    ``group`` is 1 for toxic plus 2 for held. The rows are handed on in batches, because a batch lies whole outside
    the heap of the executor.
    """
    order = np.argsort(keys)
    keys, group = keys[order], group[order]
    del order
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    for start in range(0, len(first), BATCH_KEYS):
        at = first[start:start + BATCH_KEYS]
        stop = first[start + BATCH_KEYS] if start + BATCH_KEYS < len(first) else len(keys)
        own, bounds = group[at[0]:stop], at - at[0]

        def count(chosen: np.ndarray) -> np.ndarray:
            return np.add.reduceat(chosen, bounds, dtype=np.int64)

        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(at), kind, np.int8)), W.as_long(keys[at]),
            *(pa.array(count(chosen)) for chosen in (own & 1 == 1, own & 1 == 0, own == 3, own == 2)),
        ], ["kind", "pair", "t", "o", "held_t", "held_o"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (word before, word) and (beginning, word) with counts in toxic and ordinary texts."""
    pairs, stems, groups = [], [], []

    def flush() -> Iterator[pa.RecordBatch]:
        if groups:
            group = np.concatenate(groups)
            groups.clear()
            for kind, parts in enumerate((pairs, stems)):
                keys = np.concatenate(parts)
                parts.clear()
                yield from _summed(kind, keys, group)

    kept = 0
    for batch in batches:
        for piece in W.pieces(batch, "text"):
            before, word, stem, first = named(*W.texts_of(piece.column("text")))
            pairs.append(before << np.uint64(32) | word)
            stems.append(stem << np.uint64(32) | word)
            label, held = (piece.column(c).to_numpy(zero_copy_only=False).astype(np.uint8) for c in ("label", "held"))
            groups.append(np.repeat(label + 2 * held, np.diff(first)))
            kept += len(word)
            if kept > BLOCK_WORDS:
                yield from flush()
                kept = 0
    yield from flush()


def _positive(count: str) -> Column:
    return F.sum((F.col(count) > 0).cast("bigint"))


def _exact_sum(value: Column) -> Column:
    """Sum of fractions that does not depend on their order."""
    return F.coalesce(F.sum(F.round(value * SCALE).cast("bigint")), F.lit(0)) / SCALE


def _different(count: str, share: float) -> Column:
    """How many different pairs are expected in this share of the text."""
    return F.lit(1.0) - F.pow(F.lit(1.0 - min(share, 1.0)), F.col(count))


def _first(pair: str = "pair") -> Column:
    return F.shiftrightunsigned(pair, 32)


def _second(pair: str = "pair") -> Column:
    return F.col(pair).bitwiseAND(F.lit(0xFFFFFFFF))


def training_rows(documents: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """All labelled texts outside the held-out fold, with ``label`` 1 for toxic."""
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & usable)
        .groupBy(F.col("doc_id").alias("label_id")).agg((F.max("toxic") > 0).cast("int").alias("label"))
    )
    few = ids.limit(SENT_IDS + 1).count() <= SENT_IDS
    return documents.where("text is not null").select("doc_id", "text").join(
        F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "label")


def calibration_texts(rows: DataFrame, slice_ids: DataFrame) -> DataFrame:
    """One labelled text for each id of the slice; of the rows of a repeated id the smallest text counts."""
    return rows.join(F.broadcast(slice_ids), F.col("doc_id") == F.col("slice_id")).groupBy("slice_id").agg(
        F.min("label").cast("bigint").alias("label"), F.min("text").alias("text")).select("label", "text")


def _in_slice() -> Column:
    return F.pmod(F.xxhash64(F.lit("curve"), F.col("doc_id")), F.lit(CALIBRATION_SLICE)) == 0


def _g_test(t: Column, o: Column, share: Column) -> Column:
    """How clearly the counts contradict the share of toxic ones that is expected."""
    def part(count: Column, expected: Column) -> Column:
        return F.when(count > 0, count * F.log(count / ((t + o) * expected))).otherwise(0.0)

    return 2 * (part(t, share) + part(o, 1 - share))


PAIR, WORD, STEM = 0, 1, 2


def _model(spark: SparkSession, steps: DataFrame) -> Model:
    """The most frequent steps as arrays, all others in a table."""
    sent, rest = steps, None
    if steps.count() > SENT_ROWS:
        sent = stored(spark, steps.orderBy(F.desc("seen"), "kind", "key").limit(SENT_ROWS), "toxicity-sent")
        rest = stored(spark, steps.join(sent.select("kind", "key"), ["kind", "key"], "left_anti").select(
            "kind", "key", "step"), "toxicity-rest")
    found = sent.select("kind", "key", "step").toPandas()
    arrays = []
    for kind in (PAIR, WORD, STEM):
        part = found[found["kind"] == kind]
        keys = part["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        arrays += [keys[order], part["step"].to_numpy(np.int64)[order]]
    return Model(*arrays, rest, np.zeros(3))


def _steps(spark: SparkSession, counts: DataFrame) -> DataFrame | None:
    """Steps of all expressions that contradict their backoff: ``kind``, ``key``, ``seen``, ``step``.

    None without counts of both classes.
    """
    pairs, stem_pairs = counts.where("kind = 0"), counts.where("kind = 1")
    # Different words before each word, and the words that begin alike.
    size_t, size_o = one_row(pairs.agg(F.coalesce(F.sum("t"), F.lit(0)), F.coalesce(F.sum("o"), F.lit(0))))
    if not size_t or not size_o:
        return None
    words = pairs.groupBy(_second().alias("word")).agg(
        _exact_sum(_different("t", size_o / size_t)).alias("t"), _exact_sum(_different("o", size_t / size_o)).alias("o"))
    words = stored(spark, words.join(
        stem_pairs.select(_second().alias("word"), _first().alias("stem")).groupBy("word").agg(
            F.min("stem").alias("stem")), "word"), "toxicity-words")
    stems = words.groupBy("stem").agg(_exact_sum(F.col("t")).alias("t"), _exact_sum(F.col("o")).alias("o"))

    def taken(count: str) -> Column:
        return _exact_sum(F.least(F.col(count), F.lit(DISCOUNT)))

    all_t, all_o, taken_t, taken_o = one_row(words.agg(
        _exact_sum(F.col("t")), _exact_sum(F.col("o")), taken("t"), taken("o")))
    stem_t, stem_o, n_stems = one_row(stems.agg(taken("t"), taken("o"), F.count("*")))

    def discounted(count: str, total: int) -> Column:
        return F.greatest(F.col(count) - DISCOUNT, F.lit(0.0)) / F.lit(total)

    spread = F.lit(1.0 / n_stems)
    left_t, left_o = stem_t / all_t, stem_o / all_o
    expected = all_t / (all_t + all_o)

    def toxic_share(t: Column, o: Column, prior: Column) -> Column:
        return (t + prior) / (t + o + 1)

    def judged(t: str, o: str, share: Column, ratio: Column, lower: Column) -> Column:
        """The own ratio where the counts contradict the backoff, else that of the backoff."""
        own = F.round(ratio * SCALE).cast("bigint")
        return F.when(_g_test(F.col(t), F.col(o), share) >= MIN_G, own).otherwise(lower)

    def step(kind: int, key: str, t: str, o: str, lower: Column) -> list[Column]:
        return [F.lit(kind).cast("tinyint").alias("kind"), F.col(key).cast("bigint").alias("key"),
                (F.col(t) + F.col(o)).cast("double").alias("seen"), (F.col("ratio") - lower).alias("step")]

    stems = stems.withColumns({
        "pt": discounted("t", all_t) + left_t * spread, "po": discounted("o", all_o) + left_o * spread,
    })
    nothing = F.lit(0).cast("bigint")
    stems = stems.withColumn("ratio", judged("t", "o", F.lit(expected), F.log(F.col("pt") / F.col("po")), nothing))
    of_stem = stems.select("stem", "pt", "po", F.col("ratio").alias("lower"), (F.col("t") + F.col("o")).alias("of"),
                           toxic_share(F.col("t"), F.col("o"), F.lit(expected)).alias("stem_share"))
    share = (F.col("t") + F.col("o")) / F.col("of")
    words = words.join(of_stem, "stem").select(
        "word", "t", "o", "stem_share", "lower",
        (discounted("t", all_t) + taken_t / all_t * F.col("pt") * share).alias("pt"),
        (discounted("o", all_o) + taken_o / all_o * F.col("po") * share).alias("po"),
    ).withColumn("ratio", judged("t", "o", F.col("stem_share"), F.log(F.col("pt") / F.col("po")), F.col("lower")))
    words = stored(spark, words, "toxicity-ratios")
    # What a class keeps for unseen pairs after a word.
    before = pairs.groupBy(_first().alias("before")).agg(
        F.sum("t").alias("t"), F.sum("o").alias("o"), _positive("t").alias("kt"), _positive("o").alias("ko"))

    def left(kinds: str, total: str) -> Column:
        return F.when(F.col(total) > 0, F.lit(DISCOUNT) * F.col(kinds) / F.col(total)).otherwise(F.lit(1.0))

    before = stored(spark, before.select(
        "before", "t", "o", left("kt", "t").alias("lt"), left("ko", "o").alias("lo")), "toxicity-before")
    # Only pairs that contradict their word go on to the words before them.
    seen = pairs.select("pair", _first().alias("before"), _second().alias("word"),
                        F.col("t").alias("ct"), F.col("o").alias("co"))
    # Pairs count all text of both classes, words as much of either.
    alike = toxic_share(F.col("t"), F.col("o"), F.col("stem_share"))
    joined = seen.join(words.select("word", "pt", "po", F.col("ratio").alias("lower"), (
        alike * size_t / (alike * size_t + (1 - alike) * size_o)).alias("word_share")), "word")
    joined = joined.where(_g_test(F.col("ct"), F.col("co"), F.col("word_share")) >= MIN_G).join(before, "before")

    def bigram(count: str, total: str, kept: str, lower: str) -> Column:
        own = F.when(F.col(total) > 0, F.greatest(F.col(count) - DISCOUNT, F.lit(0.0)) / F.col(total)).otherwise(0.0)
        return own + F.col(kept) * F.col(lower)

    ratio = F.log(bigram("ct", "t", "lt", "pt") / bigram("co", "o", "lo", "po"))
    joined = joined.withColumn("ratio", F.round(ratio * SCALE).cast("bigint"))
    steps = joined.select(*step(PAIR, "pair", "ct", "co", F.col("lower"))).unionByName(
        words.select(*step(WORD, "word", "t", "o", F.col("lower")))).unionByName(
        stems.select(*step(STEM, "stem", "t", "o", nothing)))
    return stored(spark, steps.where("step <> 0"), "toxicity-steps")


def _nothing() -> Model:
    none, zero = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return Model(none, zero, none, zero, none, zero, None, np.zeros(3))


def train(spark: SparkSession, documents: DataFrame, labels: DataFrame, usable: Column) -> Model:
    """Count, compare and calibrate on labelled rows for which ``usable`` holds."""
    rows = training_rows(documents, labels, usable)
    slice_ids = stored(spark, (
        rows.where(_in_slice()).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(CALIBRATION_ROWS).select(F.col("doc_id").alias("slice_id"))
    ), "toxicity-slice")
    marked = rows.join(F.broadcast(slice_ids), F.col("doc_id") == F.col("slice_id"), "left").select(
        "text", "label", F.col("slice_id").isNotNull().cast("int").alias("held"))
    counts = stored(spark, marked.mapInArrow(
        _counts, "kind tinyint, pair bigint, t bigint, o bigint, held_t bigint, held_o bigint").groupBy(
            "kind", "pair").agg(*(F.sum(c).alias(c) for c in ("t", "o", "held_t", "held_o"))), "toxicity-counts")
    steps = _steps(spark, counts.select("kind", "pair", "t", "o"))
    if steps is None:
        return _nothing()
    others = _steps(spark, counts.select(
        "kind", "pair", (F.col("t") - F.col("held_t")).alias("t"), (F.col("o") - F.col("held_o")).alias("o")
    ).where("t + o > 0"))
    sample = calibration_texts(rows, slice_ids)
    # In a fixed order, because sums of floats depend on it.
    found = _summed_texts(spark, sample, "label", _nothing() if others is None else _model(spark, others)).toPandas(
        ).sort_values(["label", "total", "n"])
    return _model(spark, steps)._replace(curve=fit_curve(
        features(found["total"].to_numpy(float), found["n"].to_numpy(float)), found["label"].to_numpy(float)))


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the wanted keys, and which of them there are."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    known = keys[at] == wanted
    return np.where(known, values[at], 0), known


def _grams(piece: pa.RecordBatch, model: Model) -> tuple[list[tuple], np.ndarray]:
    """Kind, sorted keys, their steps and the wanted keys of the n-grams at every word; first word per text."""
    before, word, stem, first = named(*W.texts_of(piece.column("text")))
    return [
        (STEM, model.stems, model.stem_step, stem), (WORD, model.words, model.word_step, word),
        (PAIR, model.pairs, model.pair_step, before << np.uint64(32) | word),
    ], first


def _sums(batch: pa.RecordBatch, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the steps that were sent and number of words of each text of a batch."""
    sums, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for piece in W.pieces(batch, "text"):
        grams, first = _grams(piece, model)
        ratio = sum(_lookup(keys, steps, wanted)[0] for _, keys, steps, wanted in grams)
        count = np.diff(first)
        sums.append(np.where(count, np.add.reduceat(np.append(ratio, 0), first[:-1]), 0))
        counts.append(count)
    return np.concatenate(sums), np.concatenate(counts)


def totals(batch: pa.RecordBatch, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the log ratios that were sent and number of words of each text of a batch."""
    total, n = _sums(batch, model)
    return total / SCALE, n


def _sums_of(shared, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, n = _sums(batch, shared.value)
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, keep), pa.array(total, pa.int64()), pa.array(n, pa.int64())], [*keep, "total", "n"])

    return run


def _unsent(shared):
    """N-grams of each text that were not sent, with how often they occur in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                grams, first = _grams(piece, shared.value)
                row = np.repeat(np.arange(len(piece)), np.diff(first))
                for kind, keys, steps, wanted in grams:
                    other = ~_lookup(keys, steps, wanted)[1]
                    found, times = np.unique(np.stack([row[other].astype(np.uint64), wanted[other]]), axis=1,
                                             return_counts=True)
                    at = pa.array(found[0].astype(np.int64))
                    yield pa.RecordBatch.from_arrays([
                        piece.column("a").take(at), piece.column("b").take(at),
                        pa.array(np.full(len(at), kind, np.int8)), W.as_long(found[1]), pa.array(times.astype(np.int64)),
                    ], ["a", "b", "kind", "key", "times"])

    return run


def _summed_texts(spark: SparkSession, texts: DataFrame, key: str, model: Model) -> DataFrame:
    """Per row of ``texts``: the bigint ``key``, the sum of its log ratios ``total`` and its number of words ``n``."""
    shared = spark.sparkContext.broadcast(model._replace(rest=None))
    if model.rest is None:
        sums = texts.select(key, "text").mapInArrow(_sums_of(shared, [key]), f"{key} bigint, total bigint, n bigint")
        return sums.withColumn("total", F.col("total") / SCALE)
    # Texts are known by 128 bits; equal texts have equal sums, so the sum over all copies is divided by their number.
    texts = texts.select(key, "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("a"),
                         F.xxhash64(F.lit("b"), F.coalesce("text", F.lit(""))).alias("b"))
    sums = texts.mapInArrow(_sums_of(shared, [key, "a", "b"]), f"{key} bigint, a bigint, b bigint, total bigint, n bigint")
    copies = texts.groupBy("a", "b").agg(F.count("*").alias("copies"))
    more = texts.mapInArrow(_unsent(shared), "a bigint, b bigint, kind tinyint, key bigint, times bigint").join(
        model.rest, ["kind", "key"]).groupBy("a", "b").agg(F.sum(F.col("times") * F.col("step")).alias("more"))
    more = more.join(copies, ["a", "b"]).selectExpr("a", "b", "more div copies as more")
    return sums.join(more, ["a", "b"], "left").select(
        key, ((F.col("total") + F.coalesce("more", F.lit(0))) / SCALE).alias("total"), "n")


def features(total: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Length-normalised ratios: per word, and per root of the number of words.

    Both grow by the logarithm, because some expressions are rare and others
    frequent, and clear evidence of either kind has to count as clear.
    """
    size = np.maximum(n, 1)

    def bent(x: np.ndarray) -> np.ndarray:
        return np.sign(x) * np.log1p(np.abs(x))

    return np.column_stack([np.ones(len(total)), bent(100 * total / size), bent(10 * total / np.sqrt(size))])


def fit_curve(x: np.ndarray, label: np.ndarray, steps: int = 50, penalty: float = 1e-3) -> np.ndarray:
    """Logistic regression by Newton steps, slightly penalised."""
    w = np.zeros(x.shape[1])
    if not len(label):
        return w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        gradient = x.T @ (p - label) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty * np.eye(len(w)), gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def _chance(total: np.ndarray, n: np.ndarray, curve: np.ndarray) -> pa.Array:
    """Value of the curve for each text."""
    margin = (features(total, n) * curve).sum(axis=1)
    return pa.array(1 / (1 + np.exp(-np.clip(margin, -35, 35))))


def _scorer(curve: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, n = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("total", "n"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _chance(total, n, curve)], ["doc_id", "score"])

    return run


def _text_scorer(shared):
    """Like :func:`_scorer`, straight from the texts, where all steps were sent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, n = totals(batch, shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _chance(total, n.astype(float), shared.value.curve)], ["doc_id", "score"])

    return run


def toxicity_scores(spark: SparkSession, documents: DataFrame, model: Model) -> DataFrame:
    """Per document: ``doc_id`` and ``score`` between 0 and 1."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if model.rest is None:
        # One pass, so that a task has one Python worker and not two.
        return texts.mapInArrow(_text_scorer(spark.sparkContext.broadcast(model)), "doc_id bigint, score double")
    return _summed_texts(spark, texts, "doc_id", model).mapInArrow(_scorer(model.curve), "doc_id bigint, score double")
