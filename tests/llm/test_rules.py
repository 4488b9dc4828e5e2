import random
from collections import Counter

from parlance.llm import rules
from tests.llm import odd


def brute(text):
    found = odd.words(text)
    windows = [tuple(found[i:i + 3]) for i in range(len(found) - 2)]
    count = Counter(windows)
    covered = {p for i, w in enumerate(windows) if count[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if odd.words(line)]
    n_words = len(found)
    failed = n_words < 50 or 100 * len(covered) > 50 * n_words
    return (n_words, sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered), failed)


def results(spark, data):
    found = rules.quality_rules(odd.table(spark, data))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_of_odd_texts(spark):
    wanted = sorted(((r[0], *brute(r[1])) for r in odd.ODD), key=repr)
    assert odd.as_rows(results(spark, odd.ODD)) == wanted


def test_counts_of_random_texts(spark):
    rng = random.Random(1)
    data = odd.rows(*("".join(rng.choice(["a ", "b ", "the ", "c\n", "\n", "# ", "\x0b", "é|"]) for _ in range(rng.randrange(90)))
                      for _ in range(120)))
    assert odd.as_rows(results(spark, data)) == sorted(((r[0], *brute(r[1])) for r in data), key=repr)


def test_empty_table(spark):
    assert rules.quality_rules(odd.table(spark, [])).count() == 0


def test_each_rule_can_reject(spark):
    good = " ".join(f"the word{i} of text{i}" for i in range(30))
    bad = {
        "symbols": " ".join(f"the%% word{i} of text{i}" for i in range(30)),
        "shouts": " ".join(f"the!! word{i}!! of!! text{i}" for i in range(30)),
        "capitals": " ".join(f"THE WORD{i} OF TEXT{i}" for i in range(30)),
        "stop words": " ".join(f"word{i}" for i in range(120)),
        "lines": "\n".join(["the same line of text"] * 60 + [f"the line {i}" for i in range(5)]),
        "words per line": "\n".join(f"the{i}" if i % 2 else "the" for i in range(80)),
        "long words": " ".join(["the"] + ["x" * 200 + str(i) for i in range(60)]),
    }
    kept = {r["doc_id"]: r["kept"] for r in rules.quality_rules(odd.table(spark, odd.rows(good, *bad.values()))).collect()}
    assert kept[0] and not any(kept[i + 1] for i in range(len(bad)))


def test_no_user_functions(spark, small):
    plan = rules.quality_rules(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text and "Generate" not in text
