import hashlib
import random
import re

from pyspark.sql import functions as F

from parlance.llm import decontaminate
from tests.llm import odd

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(text, items):
    found = re.findall(PATTERN, odd.folded(text))
    hit, ids = set(), set()
    for item_id, item in items:
        parts = re.findall(PATTERN, odd.folded(item))
        if item_id is None or not parts:
            continue
        size = min(10, len(parts))
        windows = {tuple(parts[i:i + size]) for i in range(len(parts) - size + 1)}
        for i in range(len(found) - size + 1):
            if tuple(found[i:i + size]) in windows:
                hit |= set(range(i, i + size))
                ids.add(str(item_id))
    listed = ",".join(sorted(ids))
    return len(found), len(hit), len(ids), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)


ITEMS = [
    (10, " ".join(f"q{i}" for i in range(14))), (2, "short, item"), (3, ""), (4, None), (None, "null id item"),
    (5, " ".join(f"q{i}" for i in range(3, 14))), (10, " ".join(f"q{i}" for i in range(14))), (6, "Ünï CÖDÉ 漢字"),
]
EXTRA = odd.rows(
    "before " + ", ".join(f"Q{i}" for i in range(12)) + " after short-item", "q0 q1 q2", "xshort item", "short  ITEM",
    "short item" * 2, " ".join(f"q{i % 14}" for i in range(60)), "ünï cÖDÉ 漢字", first=100,
)


def items(spark, data=ITEMS):
    return spark.createDataFrame([(*r, "extra") for r in data], "item_id bigint, text string, doc_id string")


def results(spark, data, items_table=ITEMS, **options):
    found = decontaminate.contamination(spark, odd.table(spark, data), items(spark, items_table), **options)
    return odd.as_rows(found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"))


def test_against_brute_force(spark):
    data = odd.ODD + EXTRA
    wanted = sorted(((r[0], *brute(r[1], ITEMS)) for r in data), key=repr)
    assert results(spark, data) == wanted
    # Several automata, because one may hold a few bytes only.
    assert results(spark, data, automaton_bytes=40) == wanted


def test_random_texts(spark):
    rng = random.Random(3)
    data = odd.rows(*(" ".join(f"q{rng.randrange(14) if rng.random() < .1 else i % 14}" for i in range(rng.randrange(80)))
                      for _ in range(60)))
    assert results(spark, data) == sorted(((r[0], *brute(r[1], ITEMS)) for r in data), key=repr)


def test_one_item_beyond_the_bound_is_dealt_over_several_automata(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    data = [(1, long), *((k, "a window that very many items share with one another word for word") for k in range(2, 60))]
    bound = 40_000
    pairs, parts = decontaminate.window_groups(spark, items(spark, data), automaton_bytes=bound)
    sizes = {r["part"]: r["n"] for r in pairs.groupBy("part").agg(
        F.sum(F.octet_length("pattern") + F.octet_length("item_id")).alias("n")).collect()}
    assert len(sizes) == parts > 3 and max(sizes.values()) < 1.5 * bound
    assert pairs.count() == 2991 + 58 * 4
    docs = odd.rows(
        " ".join(f"W{i}" for i in range(1495, 1520)), "x " + long + " y", data[1][1], "w1 w2 w3", " ".join(long.split()[:9]))
    assert results(spark, docs, items_table=data, automaton_bytes=bound) == sorted(
        ((r[0], *brute(r[1], data)) for r in docs), key=repr)


def test_windows_come_one_by_one():
    assert list(decontaminate.windows_of("A, b C d", 2)) == [" a b ", " b c ", " c d "]
    assert list(decontaminate.windows_of("A-b", 3)) == [" a b "]
    assert list(decontaminate.windows_of("--")) == list(decontaminate.windows_of(None)) == []
    endless = decontaminate.windows_of("word " * 2_000_000)
    assert next(endless) == " " + "word " * 10


def test_spans_are_places_of_the_original(spark):
    text = "é  before: SHORT -- item, after"
    for options in ({}, {"automaton_bytes": 40}):
        row = decontaminate.contamination(spark, odd.table(spark, odd.rows(text)), items(spark), **options).collect()[0]
        assert [text[s["start"]:s["end"]] for s in row["spans"]] == ["SHORT -- item"]


def test_filter_and_empty_tables(spark):
    docs = odd.table(spark, odd.ODD + EXTRA)
    for size in (1 << 20, 40):
        kept = decontaminate.without_contamination(spark, docs, items(spark), automaton_bytes=size)
        assert kept.columns == docs.columns
        assert odd.as_rows(kept) == sorted((r for r in odd.ODD + EXTRA if not brute(r[1], ITEMS)[-1]), key=repr)
    assert decontaminate.contamination(spark, odd.table(spark, []), items(spark)).count() == 0
    nothing = decontaminate.contamination(
        spark, docs, items(spark).limit(0))
    assert {r["n_hit"] for r in nothing.collect()} == {0}
