import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from parlance.llm import language, quality
from tests.llm import odd
from tests.llm.test_quality import read


@pytest.fixture(scope="module")
def model(spark):
    return language.train(spark, read(spark, "documents"), quality.id_fold(F.col("doc_id"), 5) != 0)


def test_held_out_accuracy(spark, model):
    documents = read(spark, "documents")
    found = language.languages(spark, documents, model).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def brute(rows, texts):
    """The model as it is defined: rows of (lang, text) to learn from, texts to score."""
    counts, totals, seen = defaultdict(Counter), Counter(), Counter(lang for lang, _ in rows)
    for lang, text in rows:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            for n in range(5):
                cut = [word] if n == 0 else language.grams_of(word, n)
                for gram in cut:
                    counts[n, gram][lang] += 1
                    totals[n, lang] += 1
    size, langs = Counter(n for n, _ in counts), sorted(seen)

    def score(n, gram):
        return [round(math.log((counts[n, gram][lang] + 0.1) / (totals[n, lang] + 0.1 * (size[n] + 1))) * 2**20)
                for lang in langs]

    out = []
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 1.0))
            continue
        sums = [round(math.log(seen[lang] / len(rows)) * 2**20) for lang in langs]
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            for n in (0, 4, 3, 2, 1):
                found = [g for g in ([word] if n == 0 else language.grams_of(word, n)) if (n, g) in counts]
                if found:
                    sums = [a + sum(xs) // len(found) for a, xs in zip(sums, zip(*(score(n, g) for g in found)))]
                    break
        best = max(range(len(langs)), key=lambda i: (sums[i], -i))
        out.append((langs[best], 1 / sum(math.exp((x - sums[best]) / 2**20) for x in sums)))
    return out


@pytest.mark.parametrize("sent", (language.SENT, 500, 0))
def test_against_brute_force_however_few_are_sent(spark, sent):
    documents = read(spark, "documents")
    learnt, scored = documents.where("doc_id % 25 = 1"), documents.where("doc_id % 4 = 0")
    odd_rows = odd.table(spark, odd.ODD).select("doc_id", "text").where("doc_id is not null")
    scored = scored.select("doc_id", "text").union(odd_rows).union(odd_rows)
    model = language.train(spark, learnt, F.lit(True), sent=sent)
    assert len(model.words) + len(model.grams) <= sent and (model.scores is None) == (sent == language.SENT)
    rows = scored.collect()
    wanted = brute([(r["lang"], r["text"]) for r in learnt.collect()], [r["text"] for r in rows])
    found = language.languages(spark, scored, model).collect()
    def ordered(triples):
        return sorted((doc_id, lang, round(score, 9)) for doc_id, lang, score in triples)
    assert ordered(found) == ordered((r["doc_id"], *w) for r, w in zip(rows, wanted, strict=True))


def test_all_words_count_and_the_sample_is_bounded_by_rows(spark):
    data = [(7, f"once{'abcdefghij'[i % 10]} twice", "en") for i in range(500)] + [(8, "drei vier", "de")]
    documents = spark.createDataFrame(data, "doc_id long, text string, lang string")
    assert language.fit_sample(documents, F.lit(True), 10).count() == 2
    model = language.train(spark, documents, F.lit(True))
    assert set(model.words) == {"oncea", "twice", "drei", "vier"}


def test_odd_rows_by_joins(spark):
    documents = read(spark, "documents")
    model = language.train(spark, documents.where("doc_id % 25 = 1"), F.lit(True), sent=100)
    found = language.languages(spark, odd.table(spark, odd.ODD), model)
    assert found.count() == len(odd.ODD)
    assert language.languages(spark, odd.table(spark, []), model).count() == 0


def test_backoff_takes_the_longest_known_grams():
    grams = {"abcd": 0, " ab": 1, "b": 2}
    assert language.backoff("abcde", grams) == (0,)
    assert language.backoff("abx", grams) == (1,)
    assert language.backoff("xby", grams) == (2,)
    assert language.backoff("zzz", grams) == ()


def test_odd_documents(spark, model):
    found = language.languages(spark, odd.table(spark, odd.ODD), model).collect()
    by_id = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found if r["doc_id"] is not None}
    assert len(found) == len(odd.ODD)
    for i in (1, 2, 3, 11):
        assert by_id[i] == ("und", 1.0)
    assert by_id[4][0] in model.languages and by_id[9][0] in model.languages
    assert language.languages(spark, odd.table(spark, []), model).count() == 0
    # Unknown characters alone: the most frequent language.
    assert language.identify("ቋንቋ", model, {})[0] == "en"


def test_without_any_sample(spark):
    nothing = language.train(spark, odd.table(spark, []), F.lit(True))
    found = language.languages(spark, odd.table(spark, odd.ODD), nothing).collect()
    assert {r["lang_pred"] for r in found} == {"und"}
