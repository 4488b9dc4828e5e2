"""Language identification: known words first, then ever shorter character n-grams.

A word that the model knows is scored by its log frequency in each language. A
word that it does not know is scored by its longest character n-grams: if none
of its 4-grams is known, by its 3-grams, and so on to single characters; each
word weighs the same. The scores of the words of a text add up to a posterior
over the languages.

The model is fitted on a sample of at most ``FIT_ROWS`` texts with a language,
those with the smallest hashes of their ids, one text per id; the bound is a
parameter. Every word and n-gram of the sample counts, also those seen once, and
all are in a stored table. The ``SENT`` most frequent ones are sent to the
executors. Where there are more, words that were not sent are looked up by
joins: the distinct ones are resolved once, with their n-grams, against the
whole table, and the results are joined to the texts by word. Scores are whole
numbers (multiples of 1 / ``SCALE``), so both ways give the same sums. All texts
are scored whole.

Defined results: a null text, or one without a letter, is ``und`` with score 1.
A text whose characters are all unknown gets the language that is most frequent
in the sample. Without any sample every text is ``und`` with score 0. Rows with
a null id are not learnt from. Repeated rows are scored alike; extra columns do
not matter. An empty table gives no rows. Of a very long text only its distinct
words are held beside it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from parlance.llm.storage import stored

FIT_ROWS = 20_000
SENT = 1_000_000  # words and n-grams that are sent; the others are joined
SCALE = 1 << 20
LONGEST = 4
SMOOTHING = 0.1
UNKNOWN = "und"
KNOWN_BACKOFFS = 200_000  # unseen words whose n-grams a task remembers

_WORD = re.compile(r"[^\W\d_]+")
_LETTER = regex.compile(r"\p{L}")


class Model(NamedTuple):
    """Log frequencies of the words and n-grams sent, one row each, one column per language, in units of 1 / SCALE."""

    languages: list[str]
    prior: np.ndarray
    words: dict[str, int]
    grams: dict[str, int]
    table: np.ndarray
    scores: DataFrame | None = None  # all words (n = 0) and n-grams, where not all were sent


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return _WORD.findall(text.lower())


def grams_of(word: str, length: int) -> list[str]:
    """Character n-grams of a word; from length two on its ends count as spaces."""
    padded = f" {word} " if length > 1 else word
    return [padded[i:i + length] for i in range(len(padded) - length + 1)]


_COUNTS = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("gram", pa.string()), ("found", pa.int64())])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (n = -1), words (n = 0) and n-grams of each language, counted per batch."""
    for batch in batches:
        words: dict[str, Counter[str]] = {}
        texts: Counter[str] = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            texts[lang] += 1
            words.setdefault(lang, Counter()).update(words_of(text.as_py()))
        for lang, found in words.items():
            # A word is cut into n-grams once, whatever the number of times it was found.
            grams: list[Counter[str]] = [found, *(Counter() for _ in range(LONGEST))]
            for word, count in found.items():
                for length in range(1, LONGEST + 1):
                    own = grams[length]
                    for gram in grams_of(word, length):
                        own[gram] += count
            yield pa.RecordBatch.from_arrays([
                pa.array([lang], pa.string()), pa.array([-1], pa.int32()), pa.array([""]), pa.array([texts[lang]]),
            ], schema=_COUNTS)
            for n, counter in enumerate(grams):
                size = len(counter)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * size, pa.string()), pa.array([n] * size, pa.int32()),
                    pa.array(list(counter), pa.string()), pa.array(list(counter.values()), pa.int64()),
                ], schema=_COUNTS)


def fit_sample(documents: DataFrame, usable, rows: int) -> DataFrame:
    """At most ``rows`` texts with a language, one per id: of the rows of a repeated id the smallest text counts."""
    labelled = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & usable)
    ids = (
        labelled.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        .select(F.col("doc_id").alias("sample_id"))
    )
    own = labelled.select("doc_id", "text", "lang").join(F.broadcast(ids), F.col("doc_id") == F.col("sample_id"))
    return own.groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("x")).select("x.text", "x.lang")


def train(spark: SparkSession, documents: DataFrame, usable, fit_rows: int = FIT_ROWS, sent: int = SENT) -> Model:
    """Fit the model on rows for which ``usable`` holds."""
    # The sample is small; dealt anew, all cores count it, however few files it came from.
    sample = fit_sample(documents, usable, fit_rows).repartition(spark.sparkContext.defaultParallelism)
    counts = sample.select("lang", "text").mapInArrow(_counts, "lang string, n int, gram string, found bigint")
    grams = stored(spark, counts.groupBy("n", "gram", "lang").agg(F.sum("found").alias("found")).groupBy("n", "gram").agg(
        F.sum("found").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "found"))).alias("by_lang"),
    ), "language-grams")
    texts = {lang: found for row in grams.where("n = -1").collect() for lang, found in row["by_lang"].items()}
    if not texts:
        return Model([], np.zeros(0, np.int64), {}, {}, np.zeros((0, 0), np.int64))
    languages = sorted(texts)
    sums = grams.select("n", F.explode("by_lang").alias("lang", "found")).groupBy("n", "lang").agg(F.sum("found").alias("found"))
    totals = {(row["n"], row["lang"]): row["found"] for row in sums.collect()}
    size = {row["n"]: row["count"] for row in grams.groupBy("n").count().collect()}

    def score(n: int, lang: str):
        scale = totals.get((n, lang), 0) + SMOOTHING * (size.get(n, 0) + 1)
        found = F.coalesce(F.try_element_at("by_lang", F.lit(lang)), F.lit(0)) + F.lit(SMOOTHING)
        return F.round(F.log(found / F.lit(scale)) * SCALE).cast("bigint")

    lengths = range(LONGEST + 1)
    by_length = [F.when(F.col("n") == n, F.array(*(score(n, lang) for lang in languages))) for n in lengths]
    scores = stored(spark, grams.where("n >= 0").select(
        "n", "gram", "total", F.coalesce(*by_length).alias("scores")), "language-scores")
    everything = sum(size.get(n, 0) for n in lengths)
    hot = scores if everything <= sent else scores.orderBy(F.desc("total"), "n", "gram").limit(sent)
    kept = hot.select("n", "gram", "scores").toArrow().combine_chunks()
    table = kept.column("scores").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    words: dict[str, int] = {}
    by_gram: dict[str, int] = {}
    for i, (n, gram) in enumerate(zip(kept.column("n").to_pylist(), kept.column("gram").to_pylist(), strict=True)):
        (words if n == 0 else by_gram)[gram] = i
    share = np.array([texts[lang] for lang in languages], float)
    prior = np.round(np.log(share / share.sum()) * SCALE).astype(np.int64)
    return Model(
        languages, prior, words, by_gram, table.reshape(-1, len(languages)), None if everything <= sent else scores)


def backoff(word: str, grams: dict[str, int]) -> tuple[int, ...]:
    """Rows of the longest known n-grams of an unseen word."""
    for length in range(LONGEST, 0, -1):
        found = tuple(i for i in map(grams.get, grams_of(word, length)) if i is not None)
        if found:
            return found
    return ()


def known_sums(text: str, model: Model) -> tuple[np.ndarray, Counter[str]]:
    """Sum of the scores of the words that were sent, and the other words with their counts."""
    rows: list[int] = []
    counts: list[int] = []
    others: Counter[str] = Counter()
    for word, count in Counter(words_of(text)).items():
        at = model.words.get(word)
        if at is None:
            others[word] = count
        else:
            rows.append(at)
            counts.append(count)
    return np.array(counts, np.int64) @ model.table[rows].astype(np.int64), others


def backed_off(word: str, model: Model) -> np.ndarray:
    """Mean score of the longest known n-grams of an unseen word, rounded down."""
    found = model.table[list(backoff(word, model.grams))].astype(np.int64)
    return found.sum(axis=0) // max(1, len(found))


def verdict(sums: np.ndarray, model: Model) -> tuple[str, float]:
    """The language of a text's sums, and its posterior."""
    total = sums + model.prior
    best = int(total.argmax())
    return model.languages[best], float(1 / np.exp((total - total[best]) / SCALE).sum())


def identify(text: str | None, model: Model, memory: dict[str, np.ndarray]) -> tuple[str, float]:
    """Language and its posterior, where the whole model was sent."""
    if not text or not _LETTER.search(text):
        return UNKNOWN, 1.0
    if not model.languages:
        return UNKNOWN, 0.0
    sums, others = known_sums(text, model)
    for word, count in others.items():
        found = memory.get(word)
        if found is None:
            if len(memory) >= KNOWN_BACKOFFS:
                memory.clear()
            found = memory[word] = backed_off(word, model)
        sums = sums + count * found
    return verdict(sums, model)


_RESULT = "doc_id bigint, lang_pred string, score double"


def _verdicts(ids: pa.Array, found: list[tuple[str, float]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        ids, pa.array([lang for lang, _ in found], pa.string()), pa.array([score for _, score in found], pa.float64()),
    ], ["doc_id", "lang_pred", "score"])


def _identifier(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        memory: dict[str, np.ndarray] = {}
        for batch in batches:
            yield _verdicts(
                batch.column("doc_id"), [identify(text.as_py(), model, memory) for text in batch.column("text")])

    return run


_PARTS = pa.schema([
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("letters", pa.bool_()), ("sums", pa.list_(pa.int64())),
    ("others", pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())]))),
])


def _partly(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = []
            for doc_id, text_key, text in zip(*(batch.column(c) for c in ("doc_id", "text_key", "text")), strict=True):
                text = text.as_py() or ""
                sums, others = known_sums(text, model)
                rows.append({
                    "doc_id": doc_id.as_py(), "text_key": text_key.as_py(), "letters": bool(_LETTER.search(text)),
                    "sums": sums.tolist(), "others": [{"word": w, "times": n} for w, n in others.items()],
                })
            yield pa.RecordBatch.from_pylist(rows, schema=_PARTS)

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word itself (n = 0) and its n-grams of all lengths, as often as it holds them."""
    for batch in batches:
        for word in batch.column("word").to_pylist():
            found = [(0, word), *((n, gram) for n in range(1, LONGEST + 1) for gram in grams_of(word, n))]
            yield pa.RecordBatch.from_arrays([
                pa.array([word] * len(found), pa.string()), pa.array([n for n, _ in found], pa.int32()),
                pa.array([gram for _, gram in found], pa.string()),
            ], ["word", "n", "gram"])


def resolved(words: DataFrame, scores: DataFrame, languages: int) -> DataFrame:
    """Per word that the whole table knows by itself or by its n-grams: ``found``, its score in each language."""
    pieces = words.mapInArrow(_pieces, "word string, n int, gram string").join(scores.drop("total"), ["n", "gram"])
    by_length = pieces.groupBy("word", "n").agg(
        F.count("*").alias("k"), *(F.sum(F.col("scores")[i]).alias(f"s{i}") for i in range(languages)))
    # Rounded down like the mean of the sent n-grams.
    mean = F.array(*((F.col(f"s{i}") - F.pmod(f"s{i}", "k")) / F.col("k") for i in range(languages)))
    rank = F.when(F.col("n") == 0, LONGEST + 1).otherwise(F.col("n"))
    return by_length.groupBy("word").agg(F.max_by(mean.cast("array<bigint>"), rank).alias("found"))


def _decider(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [
                verdict(np.array(sums, np.int64), model) if letters else (UNKNOWN, 1.0)
                for letters, sums in zip(batch.column("letters").to_pylist(), batch.column("sums").to_pylist(), strict=True)
            ]
            done = _verdicts(batch.column("doc_id"), found)
            yield done.append_column("text_key", batch.column("text_key"))

    return run


def _by_joins(spark: SparkSession, texts: DataFrame, model: Model) -> DataFrame:
    """The same scores, with the words that were not sent joined by key."""
    shared = spark.sparkContext.broadcast(model._replace(scores=None))
    size = len(model.languages)
    keyed = texts.withColumn("text_key", F.xxhash64("text"))
    parts = stored(spark, keyed.mapInArrow(_partly(shared), (
        "doc_id bigint, text_key bigint, letters boolean, sums array<bigint>, others array<struct<word:string,times:bigint>>"
    )).dropDuplicates(["doc_id", "text_key"]), "language-parts")
    others = parts.select("doc_id", "text_key", F.explode("others").alias("x")).select("doc_id", "text_key", "x.*")
    words = stored(spark, resolved(others.select("word").distinct(), model.scores, size), "language-words")
    looked_up = others.join(words, "word").select(
        "doc_id", "text_key", *((F.col("times") * F.col("found")[i]).alias(f"s{i}") for i in range(size)))
    sent = parts.select("doc_id", "text_key", *(F.col("sums")[i].alias(f"s{i}") for i in range(size)))
    sums = sent.unionByName(looked_up).groupBy("doc_id", "text_key").agg(
        F.array(*(F.sum(f"s{i}") for i in range(size))).alias("sums"))
    letters = parts.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), "letters")
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key"))
    found = sums.join(letters, same).select("doc_id", "text_key", "letters", "sums").mapInArrow(
        _decider(shared), _RESULT + ", text_key bigint")
    # The results of equal rows are equal, so they are found once per id and text; all rows stay.
    rows = keyed.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"))
    return found.join(rows, same).select("doc_id", "lang_pred", "score")


def languages(spark: SparkSession, documents: DataFrame, model: Model) -> DataFrame:
    """Per document: ``doc_id``, ``lang_pred`` and ``score``."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if model.scores is not None:
        return _by_joins(spark, texts, model)
    return texts.mapInArrow(_identifier(spark.sparkContext.broadcast(model)), _RESULT)
