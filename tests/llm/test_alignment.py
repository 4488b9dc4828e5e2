"""Alignment against a plain version that walks over all pairs of tokens of a text."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from parlance.llm import alignment
from tests.llm import odd

FILES = alignment.read_tokenizers()
A, B = alignment.load(FILES)
REFERENCE = Tokenizer.from_buffer(FILES.a)
REFERENCE.encode_special_tokens = True

TEXTS = odd.rows(
    "hi  there ", "plain words of a text, plain words", "a▁b", "<|endoftext|> and <s> </s> <unk> <0x41>",
    "\x00 nul", "\u0085 nel", "😀́ x 漢字漢字", "ﬁ ligature", "\n\n  x\t\n", " ", "plain words", "plain words",
    "the the the the", first=100,
)


def spans(ids, pieces):
    out, at = [], 0
    for number in ids:
        out.append((number, at, at + len(pieces[number])))
        at += len(pieces[number])
    return out


def tokens(text):
    if not text:
        return [], []
    a = spans(REFERENCE.encode(" " + text, add_special_tokens=False).ids, A.pieces)
    b = spans(B.encode([text])[0], B.pieces)
    whole = (" " + text).encode()
    if any(b"".join(pieces[t[0]] for t in ids) != whole for ids, pieces in ((a, A.pieces), (b, B.pieces))):
        return [], []
    return a, b


def brute(rows):
    """Contract columns by comparing every A with every B token."""
    per_row, counts = [], Counter()
    for doc_id, text in rows:
        a, b = tokens(text)
        linked = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        counts.update(linked)
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = []
        for low, high in zip([0, *cuts], cuts):
            groups.append("|".join(
                ",".join(str(t[0]) for t in side if low <= t[1] < high) for side in (a, b)))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        per_row.append((doc_id, len(a), len(b), len(groups), linked, digest))
    best = Counter()
    for (_, b_id), n in counts.items():
        best[b_id] = max(best[b_id], n)
    return sorted(((
        doc_id, n_a, n_b, n_groups, len(linked), sum(counts[p] == best[p[1]] for p in linked),
        sum(counts[p] for p in linked), digest,
    ) for doc_id, n_a, n_b, n_groups, linked, digest in per_row), key=repr)


@pytest.mark.parametrize("sent_pairs", [alignment.HOT_PAIRS, 40, 0])
def test_equals_brute_force(spark, sent_pairs):
    rows = [r for r in odd.ODD + TEXTS if r[1] != odd.LONG]
    found = alignment.cross_alignment(spark, odd.table(spark, rows).repartition(3), sent_pairs=sent_pairs)
    assert odd.as_rows(found) == brute([(r[0], r[1]) for r in rows])


def test_given_texts_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
            .where("length(text) < 1500").collect()]
    found = alignment.cross_alignment(spark, spark.createDataFrame(rows, "doc_id long, text string"), sent_pairs=500)
    assert odd.as_rows(found) == brute(rows)


def test_empty_table(spark):
    assert alignment.cross_alignment(spark, odd.table(spark, [])).collect() == []


def test_long_texts_and_long_runs():
    texts = [odd.LONG, "a" * 200_000, " " * 200_000 + "x", "é" * 50_000]
    found = alignment.chain(texts, A, B)
    assert np.array_equal(np.unique(found.a_text), np.unique(found.b_text))
    assert found.a_end[-1] == found.b_end[-1]
    assert len(np.unique(alignment.terminals(found.a_end, found.b_end))) == len(
        np.intersect1d(found.a_end, found.b_end))


@given(st.lists(st.integers(1, 6), min_size=1, max_size=40), st.lists(st.integers(1, 6), min_size=1, max_size=40))
@settings(deadline=None, max_examples=200)
def test_terminals_are_the_common_cuts(a, b):
    a_end, b_end = np.cumsum(a), np.cumsum(b)
    total = min(a_end[-1], b_end[-1])
    a_end = np.unique(np.append(a_end[a_end < total], total))
    b_end = np.unique(np.append(b_end[b_end < total], total))
    label = alignment.terminals(a_end, b_end)
    cuts = np.intersect1d(a_end, b_end)
    wanted = [cuts[np.searchsorted(cuts, e)] for e in [*a_end, *b_end]]
    assert [b_end[k - len(a_end)] for k in label] == wanted
    assert (label >= len(a_end)).all()


@given(st.text(max_size=60))
@settings(deadline=None, max_examples=300)
def test_same_ids_as_the_file_read_by_its_own_library(text):
    assert A.encode([" " + text])[0] == REFERENCE.encode(" " + text, add_special_tokens=False).ids


def test_hot_pairs_stay_below_the_limit(spark):
    pairs = spark.createDataFrame([(i, 1, 1 + i % 50, False) for i in range(1000)], "a int, b int, n long, best boolean")
    for limit in (0, 1, 19, 100, 999, 5000):
        hot, is_cold = alignment.hot_pairs(pairs, limit)
        assert len(hot.key) <= limit
        assert len(hot.key) + pairs.where(is_cold).count() == 1000
        assert not len(hot.n) or hot.n.min() > max([r["n"] for r in pairs.where(is_cold).collect()], default=0)
