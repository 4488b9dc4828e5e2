"""Ranked search against a plain version that scores every document for every item."""

import math
import re

import numpy as np
import pytest

from parlance.llm import lexical
from parlance.llm import words as W
from tests.llm import odd

ITEMS = [
    (1, "One, a B c"), (2, "漢字 ünï w1 w2 w3"), (3, ""), (4, None), (5, "... !"), (None, "a e"), (6, "zzz nowhere"),
    (1, "one more term: W5"), (7, "a a a a"), (8, " ".join(f"w{i}" for i in range(40))),
]
EXTRA = odd.rows(
    *["copy of a text with w1 and w2"] * 130, *[f"a b w{i % 7} w{i % 11} c" for i in range(120)],
    "W1, w2; w3-w4", "w1w2", "ünï Ünï ÜNÏ", "\U0001F600 a", "w1\x00w2", first=100,
)


def found_terms(text):
    return re.findall(lexical.TERM, odd.folded(text))


def brute(documents, items, top=50):
    rows = [(r[0], found_terms(r[1])) for r in documents]
    rows = [(i, t) for i, t in rows if t]
    total = sum(len(t) for _, t in rows)
    df = {}
    for _, t in rows:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(found_terms(text))
    out = []
    for item_id, wanted in asked.items():
        scored = []
        for doc_id, t in rows:
            m = 50 + 50 * len(t) * len(rows) // total
            score = 0
            for term in wanted & set(t):
                tf = t.count(term)
                w = math.floor(1000 * math.log((2 * len(rows) + 2) / (2 * df[term] + 1)))
                score += w * (1000000000 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def items_table(spark, rows):
    return spark.createDataFrame([(a, b, "x") for a, b in rows], "item_id long, text string, term string")


@pytest.mark.parametrize("block_terms", [lexical.BLOCK_TERMS, 50, 8, 0])
def test_equals_brute_force(spark, block_terms):
    documents = odd.ODD + EXTRA
    found = lexical.ranked_search(
        spark, odd.table(spark, documents).repartition(3), items_table(spark, ITEMS), block_terms=block_terms)
    assert odd.as_rows(found) == brute([(r[0], r[1]) for r in documents], ITEMS)


def test_given_tables_equal_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    documents, items = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "benchmark"))
    found = lexical.ranked_search(spark, documents, items)
    wanted = brute([tuple(r) for r in documents.select("doc_id", "text").collect()],
                   [tuple(r) for r in items.select("item_id", "text").collect()])
    assert odd.as_rows(found) == wanted


def test_one_large_class_is_expanded_by_id(spark):
    rows = odd.rows(*[(1000 - i, "same words here") for i in range(400)], (2000, "here"), (2001, "other"))
    found = lexical.ranked_search(spark, odd.table(spark, rows).repartition(8), items_table(spark, [(1, "words here")]))
    assert [r["doc_id"] for r in found.orderBy("rank").collect()] == list(range(601, 651))


def test_no_documents_or_no_items(spark):
    documents, items = odd.table(spark, odd.ODD), items_table(spark, ITEMS)
    for a, b in ((documents.limit(0), items), (documents, items.limit(0)), (documents.limit(0), items.limit(0))):
        found = lexical.ranked_search(spark, a, b)
        assert found.collect() == []
        assert found.columns == ["item_id", "rank", "doc_id", "score"]


def test_equal_hashes_are_told_apart(monkeypatch):
    v, number = lexical.vocabulary(["alpha", "beta", "gamma", "be"])
    crowded = v._replace(hash=np.zeros(4, np.uint64))
    data, offsets = W.texts_of(__import__("pyarrow").array(["gamma alpha delta be beta"]))
    found = W.words_of(data, offsets, lexical.TERM_BYTES)
    found = found._replace(hash=np.zeros(5, np.uint64))
    assert lexical.find_terms(data, found, crowded).tolist() == [number[2], number[0], -1, number[3], number[1]]
