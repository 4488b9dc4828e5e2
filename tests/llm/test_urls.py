"""URL filters against plain versions: every split of a name, and naive Bayes with dictionaries."""

import itertools
import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from parlance.llm import urls
from parlance.llm.queries import URL_RULES

TEXT = "<html><!-- note <b>no</b> --><script>var cheap = 'no';</script><p class='x'>Good garden news today, garden " \
       "shop. Free news</p><STYLE>p {}</STYLE></html>"
PAGES = [
    (1, "https://www.GardenNews.example.com/en/12.html?x=1", TEXT),
    (2, "https://shop.garden.example.org/fr/spring-news#top", TEXT),
    (3, "http://cheap-pills.example.com/en/1", TEXT),
    (4, "http://cheappills.example.com/en/buy", TEXT),
    (5, "http://free-bets.example.org/en/win/5", TEXT),
    (6, "https://spamfarm.example.org/es/win", "<p>x</p>"),
    (7, "https://todaynews.example.net/en/7", None),
    (8, "https://todaynews.example.net/de/7", ""),
    (9, "https://a.example.com/de/", "<p>good"),
    (10, None, TEXT), (11, "", None), (12, "no scheme.example.net/en/", None), (13, "https://", None),
    (14, "https://net", None), (15, "https://net/", None), (16, "https://xnet/", None),
    (17, "x://Y.NET/a://b/c?d#e", None), (18, "https://h.org?/fr/", None), (19, "https://h.org/fr/#/x", None),
    (None, "https://garden.example.com/en/3", None), (7, "https://todaynews.example.net/en/7", None),
    (20, "https://" + "a" * 5000 + ".example.com/" + "b/" * 5000, None), (21, "https://ÜBER-garten.example.com/Ä\n1", None),
]


def table(spark, rows=PAGES):
    out = [(*row, "extra", 1) for row in rows]
    return spark.createDataFrame(out, "page_id long, url string, html string, words string, rule int")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.partition("://")[2]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def letters(text):
    return re.findall(r"[^\W\d_]+", text)


def plain_counts(rows, listed):
    counts = Counter()
    for _, _, html in rows:
        text = re.sub(r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^<>]*>", " ", html or "")
        counts.update(w for w in letters(text.lower()) if len(w) <= urls.MAX_WORD)
    for host in {parts(url)[0] for _, url, _ in rows}:
        for label in host.split("."):
            if "-" in label:
                counts.update(letters(label))
    floor = max(1, math.ceil(sum(counts.values()) * urls.LISTED))
    for word in listed:
        counts[word] += floor
    return counts


def plain_split(piece, counts):
    total = sum(counts.values())
    if len(piece) > 63:
        return [piece]
    known = [(a + 1, b - a, counts[piece[a:b]]) for a in range(len(piece)) for b in range(a + 1, len(piece) + 1)
             if b - a <= urls.MAX_WORD and piece[a:b] in counts]
    return urls.best_split(piece, known, total)


def plain_verdicts(rows, listed, rules):
    counts = plain_counts(rows, listed)
    hosts = {}
    sites = {}
    for _, url, _ in rows:
        host, path = parts(url)
        if letters(host):
            hosts[host] = [w for piece in letters(host) for w in plain_split(piece, counts)]
            sites.setdefault(host, set(hosts[host])).update(words_of_path(path))
    bad_sites = {h for h, words in hosts.items() if set(words) & set(listed)}
    bad, good = Counter(listed), Counter()
    for host, words in sites.items():
        (bad if host in bad_sites else good).update(words)
    size = len(set(bad) | set(good))

    def weight(word):
        if not bad[word] and not good[word]:
            return None
        return round(1e6 * (
            math.log((bad[word] + 0.01) / (sum(bad.values()) + 0.01 * size))
            - math.log((good[word] + 0.01) / (sum(good.values()) + 0.01 * size))))

    prior = round(1e6 * (math.log(len(bad_sites) + 1) - math.log(len(hosts) - len(bad_sites) + 1)))
    out = []
    for page_id, url, _ in rows:
        host, path = parts(url)
        fitting = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fitting, key=lambda r: len(r.pattern), default=None)
        found = [w for w in map(weight, hosts.get(host, []) + words_of_path(path)) if w is not None]
        score = prior + sum(found)
        verdict = rule.verdict if rule else "block" if found and score > 0 else "allow"
        out.append((page_id, host, path, rule.pattern if rule else None, verdict, score))
    return out


def words_of_path(path):
    return ["0" if w[0].isdigit() else w.lower() for w in re.findall(r"[^\W\d_]+|[0-9]+", path)]


def test_equals_plain_version(spark):
    pages = table(spark).repartition(4)
    model = urls.train(spark, pages)
    found = urls.judged(spark, pages, model, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")
    found = sorted(((*r[:5], round(r[5] * 1e6)) for r in map(tuple, found.collect())), key=repr)
    wanted = sorted(plain_verdicts(PAGES, urls.BLOCK_WORDS, URL_RULES), key=repr)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    # The logarithms of two libraries may round to neighbours.
    assert all(abs(a[5] - b[5]) <= 20 + len(a[2]) for a, b in zip(found, wanted))


def test_given_pages_equal_plain_version(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    found = urls.judged(spark, pages, urls.train(spark, pages), URL_RULES)
    found = sorted(map(tuple, found.select("page_id", "host", "path", "rule", "verdict").collect()))
    assert found == sorted(r[:5] for r in plain_verdicts(rows, urls.BLOCK_WORDS, URL_RULES))


def test_names_without_hyphens_are_cut_and_blocked(spark):
    pages = table(spark)
    found = {r["page_id"]: r for r in urls.judged(spark, pages, urls.train(spark, pages), URL_RULES).collect()}
    assert found[1]["words"] == ["www", "garden", "news", "example", "com"]
    assert found[4]["words"][:2] == ["cheap", "pills"]
    assert {i: found[i]["verdict"] for i in (1, 2, 3, 4, 5, 6)} == {
        1: "allow", 2: "allow", 3: "block", 4: "block", 5: "block", 6: "block"}


def test_longest_rule_wins(spark):
    cases = {
        "https://a.net/x": "net/", "https://example.net/en/1": "example.net/en/", "https://xexample.net/en/1": "net/",
        "https://b.example.net/en": "net/", "https://example.com/de/": "example.com/de/", "https://example.com/en/": None,
        "https://a.b.org/fr/": "org/fr/", "https://b.org/FR/": None, "https://net/": "net/", "https://net": None,
        "https://b.org/fr/?a": "org/fr/", "https://x.com?net/": None,
    }
    pages = spark.createDataFrame(list(cases.items()), "url string, wanted string").select(
        "wanted", urls.fitting_rule(urls.host(F.col("url")), urls.path(F.col("url")), URL_RULES)["pattern"].alias("rule"))
    assert all(r["wanted"] == r["rule"] for r in pages.collect())


def test_empty_tables_and_lists(spark):
    none = table(spark, [])
    assert urls.judged(spark, none, urls.train(spark, none), URL_RULES).collect() == []
    pages = table(spark)
    found = urls.judged(spark, pages, urls.train(spark, none, []), [])
    assert {(r["rule"], r["verdict"]) for r in found.collect()} == {(None, "allow")}
    assert found.count() == len(PAGES)


@pytest.mark.parametrize("total", [40, 10_000])
@given(piece=st.text("abc", min_size=1, max_size=8),
       counts=st.dictionaries(st.text("abc", min_size=1, max_size=4), st.integers(1, 30), max_size=12))
@settings(deadline=None, max_examples=150)
def test_best_of_all_splits(total, piece, counts):
    def cost(words):
        return sum(round(1e6 * (math.log(total) - math.log(counts[w]))) if w in counts
                   else urls._unknown(len(w), total) for w in words)

    def splits():
        for cuts in itertools.product((False, True), repeat=len(piece) - 1):
            ends = [0, *(i + 1 for i, cut in enumerate(cuts) if cut), len(piece)]
            yield [piece[a:b] for a, b in zip(ends, ends[1:])]

    known = [(a + 1, b - a, counts[piece[a:b]]) for a in range(len(piece)) for b in range(a + 1, len(piece) + 1)
             if piece[a:b] in counts]
    found = urls.best_split(piece, known, total)
    wanted = min(splits(), key=lambda s: (cost(s), len(s), [-len(w) for w in reversed(s)]))
    assert found == wanted
