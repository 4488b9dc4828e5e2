import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from parlance.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ z\t\n\r\x0b\x00.,09é漢\U0001F600%", max_size=40)), max_size=8)
PATTERNS = {
    "spaced": (W.SPACED, r"[^\x20\x09-\x0D]+"),
    "alnum": (W.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
}


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    column = pa.array(texts, pa.string())
    for classes, pattern in PATTERNS.values():
        data, offsets = W.texts_of(column)
        found = W.words_of(W.FOLD[data], offsets, classes)
        lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
        wanted = [w for t in lower for w in re.findall(pattern, t)]
        assert [bytes(W.FOLD[data][a:b]).decode() for a, b in zip(found.start, found.end, strict=True)] == wanted
        assert np.diff(found.first).tolist() == [len(re.findall(pattern, t)) for t in lower]
        by_hash = {}
        for w, h in zip(wanted, found.hash.tolist(), strict=True):
            assert by_hash.setdefault(w, h) == h
        assert len(set(by_hash.values())) == len(by_hash)


@settings(max_examples=50, deadline=None)
@given(TEXTS)
def test_hashes_do_not_depend_on_the_texts_around(texts):
    column = pa.array(texts, pa.string())
    together = W.words_of(*W.texts_of(column), W.MARKED)
    for i in range(len(texts)):
        alone = W.words_of(*W.texts_of(column.slice(i, 1)), W.MARKED)
        assert together.hash[together.first[i]:together.first[i + 1]].tolist() == alone.hash.tolist()


def test_pieces_keep_all_rows_and_whole_texts():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 50, None, "", "b" * 5, "c" * 200, "d"], "i": list(range(6))})
    parts = list(W.pieces(batch, "text", 60))
    assert [v for p in parts for v in p.column("i").to_pylist()] == list(range(6))
    assert len(parts) > 1
    assert list(W.pieces(batch.slice(0, 0), "text")) == []


def test_runs_of_values():
    values = np.arange(10, dtype=np.uint64)
    assert len(W.runs_hash(values, 4)) == 7
    assert len(W.runs_hash(values[:3], 4)) == 0
    assert len(set(W.runs_hash(values, 1).tolist()) | set(W.runs_hash(values, 2).tolist())) == 19
