import random
from collections import defaultdict

import pytest

from parlance.llm import mixing
from tests.llm import odd


def shares(sizes, weights=(5, 2, 1), budget=1.5, most=2.0):
    """The sharing, round by round."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = budget * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= most * sizes[s]}
        if not over:
            target.update({s: left * weight[s] / total for s in open_})
            break
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def documents(spark, parts):
    """Rows of (source, number of words)."""
    out = []
    for i, (source, size) in enumerate(parts):
        text = None if size is None else " ".join(["w"] * size)
        out.append((i, text, "en", source, 0, "x", "y", 0.5, "z"))
    return odd.table(spark, out)


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_words_taken(spark, seed):
    rng = random.Random(seed)
    names = [None, "a", "b", "Z", "é", "zz", "\U0001F600"][: rng.randrange(1, 8)]
    parts = [(rng.choice(names), rng.choice([None, 0, 1, 5, 40, 300])) for _ in range(400)]
    sizes = defaultdict(int)
    for source, size in parts:
        sizes[source] += size or 0
    wanted = shares(sizes)
    found = mixing.mixed(spark, documents(spark, parts)).collect()
    assert len(found) == len(parts)
    taken = defaultdict(int)
    for r in found:
        assert r["size"] == (parts[r["doc_id"]][1] or 0) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(wanted[r["source"]], rel=1e-9, abs=1e-9)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= max(0.05 * target, 600)


def test_reruns_agree_and_the_mix_is_the_plan(spark):
    rng = random.Random(9)
    docs = documents(spark, [(rng.choice("abc"), rng.randrange(30)) for _ in range(200)])
    plan = odd.as_rows(mixing.mixed(spark, docs))
    assert plan == odd.as_rows(mixing.mixed(spark, docs.repartition(7)))
    mix = mixing.mix_documents(spark, docs)
    assert mix.columns == docs.columns
    copies = defaultdict(int)
    for r in mix.collect():
        copies[r["doc_id"]] += 1
    assert dict(copies) == {r["doc_id"]: r["copies"] for r in mixing.mixed(spark, docs).collect() if r["copies"]}


@pytest.mark.parametrize("extra", (0.3, 0.7))
def test_chance_of_a_copy_is_the_fraction_for_every_size(spark, extra):
    """Sources of one long document and many of one word, each with the rate 1 + extra."""
    sources, long, short = 240, 300, 24
    parts = [(f"s{k}", size) for k in range(sources) for size in [long] + [1] * short]
    found = mixing.mixed(spark, documents(spark, parts), weights=(1,), budget=1 + extra).collect()
    assert {r["copies"] for r in found} == {1, 2}
    for size, n in ((long, sources), (1, sources * short)):
        copied = sum(r["copies"] == 2 for r in found if r["size"] == size)
        assert abs(copied / n - extra) <= 3 * (extra * (1 - extra) / n) ** 0.5, size


def test_words_of_an_even_source_come_near_its_target(spark):
    """A class of n documents copies its share up to those of one bin, where independent coins stray by sqrt(n)."""
    found = mixing.mixed(spark, documents(spark, [("a", 6)] * 900 + [("b", 6)] * 100), budget=1.4, weights=(1,)).collect()
    taken, targets = defaultdict(int), {r["source"]: r["target"] for r in found}
    for r in found:
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target) <= 3 * 6 for s, target in targets.items())


def test_odd_documents(spark):
    docs = odd.table(spark, odd.ODD)
    found = mixing.mixed(spark, docs)
    assert found.count() == len(odd.ODD)
    assert mixing.mix_documents(spark, docs).columns == docs.columns
    assert mixing.mixed(spark, odd.table(spark, [])).count() == 0
    assert mixing.mix_documents(spark, odd.table(spark, [])).count() == 0
    nothing = mixing.mixed(spark, odd.table(spark, odd.rows(None, "")))
    assert {(r["size"], r["target"], r["taken"]) for r in nothing.collect()} == {(0, 0.0, 0)}


def test_no_python_in_the_plan(spark, small):
    plan = mixing.mixed(spark, spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().executedPlan()
    assert "Python" not in plan.toString() and "Arrow" not in plan.toString()
