import collections
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parlance.llm import quality, toxicity, words as W
from tests.llm import odd
from tests.llm.test_quality import read


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.train(
        spark, read(spark, "documents"), read(spark, "labels"), quality.id_fold(F.col("doc_id"), 3) != 1)


def test_held_out_accuracy(spark, model):
    documents, labels = read(spark, "documents"), read(spark, "labels")
    scores = toxicity.toxicity_scores(spark, documents, model).join(labels, "doc_id").toPandas()
    held = np.array([zlib.crc32(str(i).encode()) % 3 == 1 for i in scores["doc_id"]])
    found = scores[held]
    assert ((found["score"] >= 0.7) & (found["toxic"] == 1)).sum() >= 0.8 * (found["toxic"] == 1).sum()
    assert ((found["score"] >= 0.7) & (found["toxic"] == 0)).sum() <= 0.02 * (found["toxic"] == 0).sum()
    assert scores["score"].between(0, 1).all()


def test_relatives_of_a_rare_expression_are_judged_alike(spark):
    """A word never seen is judged by words that begin like it."""
    rng = np.random.default_rng(1)
    plain = [f"word{i}x" for i in range(300)]
    data, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = list(rng.choice(plain, 60))
        if toxic:
            words[5::12] = [f"grobian{k}" for k in rng.integers(0, 30, len(words[5::12]))]
        data.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = odd.table(spark, odd.rows(*data))
    model = toxicity.train(spark, docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), F.lit(True))
    probe = odd.rows(" ".join([*plain[:50], "grobianus", "grobians", "grobiane"]), " ".join(plain[:53]))
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(spark, odd.table(spark, probe), model).collect()}
    assert scores[0] >= 0.7 and scores[1] <= 0.3


def test_totals_do_not_depend_on_the_texts_around(model):
    texts = ["you idiot and the idiot", None, "", "IDIOT!! idiot", "the and of", "you idiot and the idiot"]
    total, n = toxicity.totals(pa.RecordBatch.from_pydict({"text": texts}), model)
    assert n.tolist() == [5, 0, 0, 2, 3, 5] and total[0] == total[5] and total[1] == total[2] == 0
    for i, text in enumerate(texts):
        alone = toxicity.totals(pa.RecordBatch.from_arrays([pa.array([text], pa.string())], ["text"]), model)
        assert alone[0][0] == total[i] and alone[1][0] == n[i]


def test_odd_documents(spark, model):
    docs = odd.table(spark, odd.ODD)
    found = toxicity.toxicity_scores(spark, docs, model).collect()
    assert len(found) == len(odd.ODD) and all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["doc_id"] in (1, 2, 3, 11)}) == 1
    assert toxicity.toxicity_scores(spark, odd.table(spark, []), model).count() == 0
    labels = spark.createDataFrame([(8, 1), (None, 1), (4, None)], "doc_id bigint, toxic int")
    for given in (labels, labels.limit(0)):
        nothing = toxicity.train(spark, docs, given, F.lit(True))
        assert {r["score"] for r in toxicity.toxicity_scores(spark, docs, nothing).collect()} == {0.5}


def mild(spark):
    """Texts that are toxic through many words, each less than e times likelier in them."""
    rng = np.random.default_rng(3)
    words = [f"{a}{b}rd{k}" for k in range(16) for a in "abcde" for b in "fghij"]
    odds = np.where(np.arange(400) % 2, 2.0, 1.0)
    data, labels = [], []
    for i in range(1600):
        toxic = i % 3 == 0
        p = odds if toxic else odds[::-1]
        data.append((i, " ".join(rng.choice(words, 120, p=p / p.sum()))))
        labels.append((i, int(toxic)))
    return odd.table(spark, odd.rows(*data)), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_many_mild_expressions_count(spark):
    docs, labels = mild(spark)
    scores = toxicity.toxicity_scores(spark, docs, toxicity.train(spark, docs, labels, F.lit(True))).join(
        labels, "doc_id").toPandas()
    assert (scores[scores["toxic"] == 1]["score"] >= 0.5).mean() >= 0.9
    assert (scores[scores["toxic"] == 0]["score"] >= 0.5).mean() <= 0.1


def test_scores_do_not_depend_on_what_is_sent(spark, monkeypatch):
    docs, labels = mild(spark)
    docs = docs.unionByName(docs.limit(50)).unionByName(odd.table(spark, odd.ODD))

    def scores():
        model = toxicity.train(spark, docs, labels, F.lit(True))
        return model, sorted((repr(r["doc_id"]), r["score"])
                             for r in toxicity.toxicity_scores(spark, docs, model).collect())

    whole, wanted = scores()
    monkeypatch.setattr(toxicity, "SENT_ROWS", 10)
    part, found = scores()
    assert whole.rest is None and part.rest.count() == len(whole.pairs) + len(whole.words) + len(whole.stems) - 10 > 0
    assert found == wanted


def test_every_training_row_is_counted(spark):
    """A bigram of one row only is known, whichever row it is."""
    rng = np.random.default_rng(4)
    words = [f"{a}{b}rd" for a in "abcdefghij" for b in "klmnopqrst"]
    told = [f"{words[k]} {words[k + 50]}" for k in range(40)]
    data = [(i, " ".join([*rng.choice(words, 60), *([told[i // 4]] * 40 if i % 4 == 0 else [])])) for i in range(160)]
    docs = odd.table(spark, odd.rows(*data))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)], "doc_id bigint, toxic int")
    model = toxicity.train(spark, docs, labels, F.lit(True))
    own = [toxicity.named(*W.texts_of(pa.array([pair]))) for pair in told]
    pairs = [before[1] << np.uint64(32) | word[1] for before, word, *_ in own]
    assert toxicity._lookup(model.pairs, model.pair_step, np.array(pairs))[1].all()


def test_the_calibration_sample_is_bounded_by_rows(spark):
    data = [(7, f"text {i}", 1) for i in range(5000)] + [(8, "other", 0), (9, "not in the slice", 1)]
    rows = spark.createDataFrame(data, "doc_id long, text string, label int")
    ids = spark.createDataFrame([(7,), (8,)], "slice_id long")
    found = sorted((r["label"], r["text"]) for r in toxicity.calibration_texts(rows, ids).collect())
    assert found == [(0, "other"), (1, "text 0")]


def told(count, size, seed=5):
    """A batch of labelled texts of few words, so that pairs repeat, and some without words."""
    rng = np.random.default_rng(seed)
    words = np.array([f"{a}{b}rd{k}" for k in range(size) for a in "abcde" for b in "fghij"])
    texts = [" ".join(rng.choice(words, 200 * (i % 7 > 0))) for i in range(count)]
    return pa.RecordBatch.from_pydict({
        "text": texts, "label": pa.array(rng.integers(0, 2, count), pa.int32()),
        "held": pa.array(rng.integers(0, 2, count), pa.int32())})


def test_counts_are_handed_on_in_bounded_batches(monkeypatch):
    batch = told(60, 1)
    wanted = collections.Counter()
    for text, label, held in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "held")), strict=True):
        before, word, stem, _ = toxicity.named(*W.texts_of(pa.array([text])))
        for kind, first in enumerate((before, stem)):
            for a, b in zip(first.tolist(), word.tolist(), strict=True):
                wanted.update({(kind, a << 32 | b, 1 - label): 1, (kind, a << 32 | b, 3 - label): held})
    for block, rows in ((3_000_000, 1 << 16), (3_000_000, 7), (500, 100), (0, 1)):
        monkeypatch.setattr(toxicity, "BLOCK_WORDS", block)
        monkeypatch.setattr(toxicity, "BATCH_KEYS", rows)
        found = collections.Counter()
        for out in toxicity._counts(iter([batch.slice(0, 25), batch.slice(25), batch.slice(60)])):
            assert 0 < len(out) <= rows
            for kind, pair, *counts in zip(*(c.to_pylist() for c in out.columns), strict=True):
                found.update({(kind, pair % (1 << 64), i): n for i, n in enumerate(counts)})
        assert +found == +wanted
    assert [*toxicity._counts(iter([]))] == [*toxicity._counts(iter([batch.slice(0, 1)]))] == []


def test_counting_takes_little_memory(monkeypatch):
    """A word takes its two keys and what sorting one kind of them needs, and a batch has few rows."""
    batch = told(5000, 400)
    size = sum(len(text.split()) for text in batch.column("text").to_pylist())
    W.powers(W.PIECE_BYTES)
    tracemalloc.start()
    rows = [len(out) for out in toxicity._counts(iter([batch.slice(i, 100) for i in range(0, 5000, 100)]))]
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert size > 800_000 and max(rows) <= 1 << 16
    assert most - 60 * W.PIECE_BYTES <= 70 * size


def test_texts_are_scored_in_one_pass(spark, model):
    plan = toxicity.toxicity_scores(spark, read(spark, "documents"), model)._jdf.queryExecution().executedPlan().toString()
    assert model.rest is None and plan.count("MapInArrow") == 1
