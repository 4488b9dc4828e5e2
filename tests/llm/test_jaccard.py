import random

import numpy as np
import pytest

from parlance.llm import jaccard
from parlance.llm.components import components
from tests.llm import odd


def shingles(text):
    found = odd.words(odd.folded(text))
    if len(found) >= 5:
        return frozenset(tuple(found[i:i + 5]) for i in range(len(found) - 4))
    return frozenset([tuple(found)]) if found else frozenset()


def brute(data):
    sets = [shingles(r[1]) for r in data]
    parent = list(range(len(data)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for k in range(i):
            if sets[i] and sets[k] and root(i) != root(k):
                both = len(sets[i] & sets[k])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[k]) - both):
                    parent[root(i)] = root(k)
    out = []
    for i, row in enumerate(data):
        ids = [data[k][0] for k in range(len(data)) if root(k) == root(i) and data[k][0] is not None]
        out.append((row[0], len(sets[i]), (min(ids) if ids else None) if sets[i] else row[0]))
    return sorted(out, key=repr)


def near_copies(rng, n, length=60, changes=2, first=0):
    """A crowd around one text: every copy differs from it in a few words, two copies in more."""
    base = [f"b{i}" for i in range(length)]
    out = []
    for i in range(n):
        words = list(base)
        for k in range(rng.randrange(changes + 1)):
            words[rng.randrange(length)] = f"x{i}_{k}"
        out.append((first + i, " ".join(words)))
    return out


def chain(n, length=60, first=0):
    """Each text links with the next ones only."""
    words = [f"c{i}" for i in range(length + 2 * n)]
    return [(first + i, " ".join(words[2 * i:2 * i + length])) for i in range(n)]


def passages(rng, n, first=0):
    """Different texts with one long passage in common."""
    common = [f"p{i}" for i in range(40)]
    return [(first + i, " ".join([f"u{first + i}_{k}" for k in range(rng.randrange(30, 60))] + common)) for i in range(n)]


@pytest.fixture(scope="module")
def crowd():
    rng = random.Random(4)
    data = near_copies(rng, 70, first=500) + near_copies(rng, 40, length=90, changes=4, first=1000) + chain(45, first=2000)
    data += passages(rng, 50, first=3000) + [(4000 + i, "just the same five words " * 3) for i in range(30)]
    rng.shuffle(data)
    return odd.rows(*data) + odd.ODD


def results(spark, data):
    found = jaccard.jaccard_groups(spark, odd.table(spark, data))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    return odd.as_rows(found)


def test_crowds_chains_and_passages(spark, crowd):
    assert results(spark, crowd) == brute(crowd)


def test_small_leaves_give_the_same(spark, crowd, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAF", 2)
    assert results(spark, crowd) == brute(crowd)


def test_the_order_of_shingles_decides_cost_only(spark, crowd, monkeypatch):
    monkeypatch.setattr(jaccard, "MAX_COMMON", 3)
    assert results(spark, crowd) == brute(crowd)


def test_thresholds_are_exact(spark):
    """Sets whose similarity is exactly 0.8, and just below."""
    words = [f"t{i}" for i in range(40)]
    data = odd.rows(" ".join(words[:22]), " ".join(words[2:22]) + " y z", " ".join(words[:20]), " ".join(words[:17]),
                    " ".join(words[:24]), " ".join(words[:29]), " ".join(words[:30]))
    assert results(spark, data) == brute(data)


def test_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert odd.as_rows(jaccard.jaccard_groups(spark, docs)) == brute(data)


def test_one_of_each_group_stays(spark, crowd):
    docs = odd.table(spark, crowd)
    kept = jaccard.one_per_group(spark, docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    groups = {(i, g) for i, n, g in brute(crowd) if n}
    wanted = {g for _, g in groups}
    ids = [r["doc_id"] for r in found if odd.words(r["text"])]
    assert len(ids) == len(wanted) and set(ids) == wanted
    # Documents without words are in no group: all rows stay.
    assert sum(not odd.words(r["text"]) for r in found) == sum(not odd.words(r[1]) for r in crowd)


def test_empty_table(spark):
    assert jaccard.jaccard_groups(spark, odd.table(spark, [])).count() == 0
    assert jaccard.one_per_group(spark, odd.table(spark, [])).count() == 0


def test_names_depend_on_the_seed_and_not_on_the_order():
    values = np.arange(9, dtype=np.uint64)
    assert jaccard._name(values, 0) == jaccard._name(values[::-1], 0) != jaccard._name(values, 1)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(200, 200), (139, 300), (5, 3)]
    found = components(spark, spark.createDataFrame(edges, "a bigint, b bigint"))
    labels = {r["node"]: r["label"] for r in found.collect()}
    assert labels == {**dict.fromkeys(range(61), 0), **dict.fromkeys([*range(100, 140), 300], 100)}
    assert components(spark, spark.createDataFrame([], "a bigint, b bigint")).count() == 0
