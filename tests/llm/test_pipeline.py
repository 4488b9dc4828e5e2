"""The pipeline against a brute-force version, stage by stage."""

import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

import corpus_pipeline
from parlance.llm import jaccard, mixing, quality, secrets
from tests.llm import odd
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_mixing import shares


def brute(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r.asDict() for r in docs.collect()]
    weights = quality.train(spark, docs, labels)
    scores = quality.scores_of(pa.RecordBatch.from_pydict({"text": [r["text"] for r in rows]}), weights)
    rows = [r for r, score in zip(rows, scores, strict=True) if score >= 0.3]
    first = {i for i, _, group in groups([(r["doc_id"], r["text"]) for r in rows]) if i == group}
    rows = [r for r in rows if r["doc_id"] in first]
    rows = [r for r in rows if not contaminated(r["text"], items)[-1]]
    for r in rows:
        r["text"] = secrets.redact(r["text"])
        r["n_chars"] = len(r["text"])
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len(odd.words(r["text"]))
    return rows, sizes, shares(sizes)


@pytest.fixture(scope="module")
def mix(spark, small):
    return [r.asDict() for r in corpus_pipeline.run(spark, small).collect()]


def test_pipeline(spark, small, mix):
    rows, sizes, targets = brute(spark, small)
    kept = {r["doc_id"]: r for r in rows}
    copies = Counter(r["doc_id"] for r in mix)
    assert set(copies) <= set(kept) and max(copies.values()) <= 2
    assert all(r == kept[r["doc_id"]] for r in mix)
    taken = defaultdict(int)
    for i, n in copies.items():
        taken[kept[i]["source"]] += n * len(odd.words(kept[i]["text"]))
    for source, target in targets.items():
        rate = target / sizes[source] if sizes[source] else 0
        own = [r["doc_id"] for r in rows if r["source"] == source]
        assert all(copies[i] in (int(rate), int(rate) + 1) for i in own)
        assert abs(taken[source] - target) <= max(0.3 * target, max(len(odd.words(r["text"])) for r in rows))


def test_stages_keep_the_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(40), small).columns == docs.columns, name
        assert stage(spark, docs.limit(0), small).count() == 0, name


def test_clean_documents_are_not_rejected(spark, small):
    """What the filtering stages drop is labelled bad, a copy, or holds a benchmark passage."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    good = {r["doc_id"] for r in spark.read.parquet(f"{small}/labels.parquet").where("quality = 1").collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.quality_classifier(spark, docs, small).collect()}
    assert len(good - kept) <= 0.01 * len(good)


def test_secrets_are_gone(mix):
    assert not any(re.search(r"AKIA[A-Z0-9]{16}", r["text"]) for r in mix)


def test_options_of_the_mix_are_those_of_the_operator():
    assert mixing.WEIGHTS == (5, 2, 1) and mixing.BUDGET == 1.5 and mixing.MAX_REPEATS == 2.0


def test_columns_named_like_those_used_inside(spark):
    data = [(i, f"word{i % 3} a b c d e f g", "s", 7, 8, "x", 9, "y", 5, 6) for i in range(9)]
    documents = spark.createDataFrame(
        data, "doc_id long, text string, source string, __node int, __id int, __kept string, __first int, __SOURCE string, __mix int, __copy int")
    kept = jaccard.one_per_group(spark, documents)
    assert kept.columns == documents.columns
    assert sorted(tuple(r) for r in kept.collect()) == sorted(data[:3])
    mix = mixing.mix_documents(spark, documents)
    assert mix.columns == documents.columns and {tuple(r) for r in mix.collect()} <= set(data)
