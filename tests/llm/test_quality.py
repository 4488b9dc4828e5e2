import zlib

import numpy as np
from pyspark.sql import functions as F

from parlance.llm import quality
from tests.conftest import SMALL
from tests.llm import odd

MIDDLE = SMALL.replace("sf0.001", "sf0.01")


def read(spark, name, folder=MIDDLE):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def test_folds_are_those_of_crc32(spark):
    ids = [0, 1, 17, 123456789, -5]
    rows = spark.createDataFrame([(i,) for i in [*ids, None]], "doc_id bigint")
    found = {r["doc_id"]: r["f"] for r in rows.select("doc_id", quality.id_fold(F.col("doc_id"), 5).alias("f")).collect()}
    assert found == {**{i: zlib.crc32(str(i).encode()) % 5 for i in ids}, None: 0}


def test_held_out_accuracy(spark):
    documents, labels = read(spark, "documents"), read(spark, "labels")
    weights = quality.train(spark, documents, labels)
    scores = quality.quality_scores(spark, documents, weights).join(labels, "doc_id").toPandas()
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in scores["doc_id"]])
    right = (scores["score"] >= 0.3) == (scores["quality"] == 1)
    assert right[held].mean() >= 0.95 and right[~held].mean() >= 0.95
    assert scores["score"].between(0, 1).all()


def test_scores_do_not_depend_on_labels_outside_or_on_order(spark):
    documents, labels = read(spark, "documents"), read(spark, "labels")
    flipped = labels.withColumn("quality", F.when(
        quality.id_fold(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one = quality.train(spark, documents, labels)
    two = quality.train(spark, documents.repartition(5), flipped.repartition(3))
    assert np.array_equal(one, two)


def test_bounded_sample(spark):
    labels = read(spark, "labels")
    sample = quality.labelled_sample(read(spark, "documents"), labels, "quality", 25, F.lit(True))
    assert sample.count() == 25


def test_odd_documents(spark):
    docs = odd.table(spark, odd.ODD)
    labels = spark.createDataFrame([(1, 1, 0), (4, None, 0), (None, 1, 1), (8, 0, 1), (8, 1, 0), (7, 1, None)],
                                   "doc_id bigint, quality int, toxic int")
    weights = quality.train(spark, docs, labels)
    found = quality.quality_scores(spark, docs, weights).collect()
    assert len(found) == len(odd.ODD) and all(0 <= r["score"] <= 1 for r in found)
    empty = {r["score"] for r in found if r["doc_id"] in (1, 2, 3)}
    assert len(empty) == 1
    assert quality.quality_scores(spark, odd.table(spark, []), weights).count() == 0
    nothing = quality.train(spark, docs, labels.limit(0))
    assert {r["score"] for r in quality.quality_scores(spark, docs, nothing).collect()} == {0.5}
    kept = quality.good_documents(spark, docs, weights, 0.0)
    assert kept.columns == docs.columns and odd.as_rows(kept) == sorted(odd.ODD, key=repr)
    assert quality.good_documents(spark, docs, weights, 1.1).count() == 0


def test_sparse_rows_are_scored_as_dense_ones(spark):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["a b b b c!!", None, "", "x", "a b b b c!!"]})
    weights = np.random.default_rng(0).normal(size=quality.BUCKETS + 1)
    dense = [1 / (1 + np.exp(-(weights[at] @ x))) for at, x in quality.sparse_rows(batch)]
    assert np.allclose(quality.scores_of(batch, weights), dense)


def test_sample_is_bounded_under_repeated_ids(spark):
    documents = odd.table(spark, odd.rows(*[(i % 7, f"text {i}") for i in range(5000)]))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(7)], "doc_id long, quality int, toxic int")
    sample = quality.labelled_sample(documents, labels, "quality", 5, F.lit(True))
    assert sample.count() == 5 and len({r["doc_id"] for r in sample.collect()}) == 5
