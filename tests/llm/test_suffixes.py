import random

import numpy as np
import pytest

from parlance.llm import suffixes
from tests.llm import odd


def brute(data, passage):
    """Merged runs of words that lie in a window that another document has too."""
    texts = [odd.words(odd.folded(r[1])) for r in data]
    owners = {}
    for row, words in zip(data, texts, strict=True):
        for i in range(len(words) - passage + 1):
            owners.setdefault(tuple(words[i:i + passage]), set()).add((row[0], row[1]))
    out = []
    for row, words in zip(data, texts, strict=True):
        runs = []
        for i in range(len(words) - passage + 1):
            if len(owners[tuple(words[i:i + passage])]) > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + passage
                else:
                    runs.append([i, i + passage])
        out.append((row[0], len(words), sum(b - a for a, b in runs), [tuple(r) for r in runs]))
    return sorted(out, key=repr)


def results(spark, docs, passage=suffixes.PASSAGE, seed=suffixes.SEED):
    found = suffixes.repeated_passages(spark, docs, passage, seed)
    return sorted(((r["doc_id"], r["n_words"], r["n_repeated"], [tuple(p) for p in r["passages"]])
                   for r in found.collect()), key=repr)


@pytest.fixture(scope="module")
def mixture():
    rng = random.Random(8)
    common = [[f"p{k}_{i}" for i in range(n)] for k, n in enumerate((49, 50, 51, 70, 140))]
    data = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(4)):
            words += [f"u{i}_{rng.randrange(10**6)}" for _ in range(rng.randrange(30))]
            passage = rng.choice(common)
            cut = rng.randrange(5) if rng.random() < 0.5 else 0
            words += passage[cut:]
        data.append((i, " ".join(words)))
    data += [(100 + i, " ".join(["again"] * n)) for i, n in enumerate((49, 50, 60, 130))]
    data += [(200, data[3][1]), (3, data[3][1]), (201, data[3][1].upper()), (202, "ab " * 90), (203, "ab " * 30 + "ab" * 70)]
    return odd.rows(*data) + odd.ODD


def test_against_brute_force(spark, mixture):
    assert results(spark, odd.table(spark, mixture)) == brute(mixture, 50)


@pytest.mark.parametrize(("passage", "seed"), [(12, 3), (5, 5), (30, 1)])
def test_other_lengths(spark, mixture, passage, seed):
    assert results(spark, odd.table(spark, mixture), passage, seed) == brute(mixture, passage)


def test_few_different_words(spark):
    """Texts of two words have many equal seeds and many equal hashes in a window."""
    rng = random.Random(1)
    data = odd.rows(*(" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(60)))
    assert results(spark, odd.table(spark, data), 10, 3) == brute(data, 10)


def test_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert results(spark, docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], 50)


def test_empty_table(spark):
    assert suffixes.repeated_passages(spark, odd.table(spark, [])).count() == 0


def test_minimisers_are_the_leftmost_smallest():
    rng = np.random.default_rng(0)
    for width in (1, 2, 5, 8, 41):
        values = rng.integers(0, 9, 200).astype(np.uint64)
        wanted = [i + int(np.argmin(values[i:i + width])) for i in range(len(values) - width + 1)]
        assert suffixes.minimisers(values, width).tolist() == wanted
