"""URL filters: policy rules first, then naive Bayes over the words of host and path.

Host names run words together, so they are cut into words first: a name is
split at dots, hyphens and digits, and each piece into the words of the most
likely sequence under a unigram model (Viterbi). The model counts the words of
all page texts and those that host names themselves delimit by hyphens. All
substrings of the distinct pieces are joined with that table by key, so it may
have any size and no part of it is sent anywhere.

A multinomial naive Bayes model judges the urls that no rule fits. Its training
texts are the sites: the words of a host and the words of the paths seen on it,
each once per site, so a host with a third of all pages counts as one site.
Nothing in the tables says which sites are unwanted. The labels come from a
parameter, ``BLOCK_WORDS``: a site is an example of unwanted ones if a word of
its host is in the list, and the words of the list are examples themselves.
Costs and weights are whole numbers, so the order of sums does not matter.

Defined results: a null url, or one without ``://``, has an empty host and path
and no words. A url without words gets 'allow' unless a rule fits it. Rows are
judged one by one, so repeated rows and rows without id are kept. Pieces of more
than 63 characters, longer than a host label can be, are one word. Among equally
likely splits the one with fewer words counts, then the one whose last words are
longest. Tables without pages, or without text, work: unknown names stay whole.
Extra columns do not matter.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parlance.llm.storage import one_row, stored

MAX_WORD = 24  # longest word of the unigram model
MAX_LABEL = 63  # longest label of a host name
SCALE = 1_000_000  # costs and weights are whole numbers of this fraction
SMOOTHING = 0.01  # added to every count of naive Bayes
LISTED = 1e-5  # share of all words that a word of the list counts as, at least

# --- Fixed values: words in the names of unwanted sites ------------------------
BLOCK_WORDS = (
    "adserver", "ads", "adult", "adware", "banner", "bet", "bets", "betting", "casino", "cheap", "clickbait",
    "counterfeit", "crack", "cracked", "escort", "gambling", "hentai", "jackpot", "keygen", "loan", "loans", "lottery",
    "malware", "payday", "pharma", "pharmacy", "phishing", "pills", "poker", "popup", "porn", "replica", "roulette",
    "scam", "sex", "slots", "spam", "spyware", "torrent", "tracker", "tracking", "viagra", "virus", "warez", "xxx",
)


class Rule(NamedTuple):
    """A rule of the policy: what to do, and the host and path it fits, as ``host/path``."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def host(url: Column) -> Column:
    """Host of a url in lower case; empty without one."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path(url: Column) -> Column:
    """Path of a url; empty without one."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Iterable[Rule]) -> Column:
    """The longest rule that fits, as a struct of ``pattern`` and ``verdict``; null without one."""
    chosen = F.lit(None).cast("struct<pattern: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):  # the last one tested is the innermost
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        chosen = F.when(fits, F.struct(F.lit(rule.pattern).alias("pattern"), F.lit(rule.verdict).alias("verdict"))) \
            .otherwise(chosen)
    return chosen


def name_pieces(host: Column) -> Column:
    """Pieces of a host name between dots, hyphens, digits and other marks, in order."""
    return F.regexp_extract_all(host, F.lit(r"([\p{L}\p{M}]+)"), F.lit(1))


def path_words(path: Column) -> Column:
    """Words of a path in order, in lower case; every number is the word 0."""
    return F.transform(
        F.regexp_extract_all(path, F.lit(r"([\p{L}\p{M}]+|[0-9]+)"), F.lit(1)),
        lambda w: F.when(w.rlike("^[0-9]"), F.lit("0")).otherwise(F.lower(w)),
    )


def visible_words(html: Column) -> Column:
    """Words of a page outside of its markup, in lower case."""
    text = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^<>]*>", " ")
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{M}]+)"), F.lit(1))


def parsed(pages: DataFrame) -> DataFrame:
    """Page ids with ``host`` and ``path``."""
    return pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))


def word_counts(spark: SparkSession, pages: DataFrame, listed: Iterable[str] = BLOCK_WORDS) -> DataFrame:
    """Unigram table: ``word`` and ``n``, from page texts, hyphenated names and the list."""
    texts = pages.select(F.explode(visible_words(F.col("html"))).alias("word"))
    labels = pages.select(host(F.col("url")).alias("host")).distinct().select(
        F.explode(F.split("host", r"\.")).alias("label")).where(F.contains("label", F.lit("-")))
    named = labels.select(F.explode(name_pieces(F.col("label"))).alias("word"))
    counted = texts.unionByName(named).where(F.length("word") <= MAX_WORD).groupBy("word").agg(F.count("*").alias("n"))
    counted = stored(spark, counted, "urls-counts")
    floor = max(1, math.ceil(one_row(counted.agg(F.coalesce(F.sum("n"), F.lit(0))))[0] * LISTED))
    known = spark.createDataFrame([(w, floor) for w in sorted(set(listed))], "word string, n long")
    return counted.unionByName(known).groupBy("word").agg(F.sum("n").alias("n"))


def best_split(piece: str, known: Iterable[tuple[int, int, int]], total: int) -> list[str]:
    """The most likely words of a piece. ``known`` holds (start from 1, length, count) of its substrings in the model."""
    if len(piece) > MAX_LABEL:
        return [piece]
    cost = {
        (start - 1, start - 1 + size): round(SCALE * (math.log(total) - math.log(n))) for start, size, n in known
    }
    # (cost, words, length of the last word as a negative number, where it starts)
    best: list[tuple[int, int, int, int]] = [(0, 0, 0, 0)]
    for end in range(1, len(piece) + 1):
        best.append(min(
            (best[start][0] + cost.get((start, end), _unknown(end - start, total)), best[start][1] + 1, start - end, start)
            for start in range(end)
        ))
    out, end = [], len(piece)
    while end:
        start = best[end][3]
        out.append(piece[start:end])
        end = start
    return out[::-1]


def _unknown(size: int, total: int) -> int:
    """Cost of a word that the model does not have: ten times less likely for each of its characters."""
    return round(SCALE * (math.log(max(total, 1)) + (size - 1) * math.log(10)))


def _splitter(total: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces, known = batch.column("piece").to_pylist(), batch.column("known").to_pylist()
            words = [best_split(p, [(k["start"], k["size"], k["n"]) for k in ks or ()], total)
                     for p, ks in zip(pieces, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("piece"), pa.array(words, pa.list_(pa.string()))], ["piece", "words"])

    return split


def split_pieces(spark: SparkSession, pieces: DataFrame, counts: DataFrame) -> DataFrame:
    """Words of each distinct ``piece``: all substrings meet the unigram table by key, then Viterbi."""
    total = one_row(counts.agg(F.coalesce(F.sum("n"), F.lit(0))))[0]
    short = pieces.where(F.length("piece") <= MAX_LABEL)
    starts = short.select("piece", F.explode(F.sequence(F.lit(1), F.length("piece"))).alias("start"))
    longest = F.least(F.lit(MAX_WORD), F.length("piece") - F.col("start") + 1)
    substrings = starts.select("piece", "start", F.explode(F.sequence(F.lit(1), longest)).alias("size")).select(
        "piece", "start", "size", F.substring("piece", F.col("start"), F.col("size")).alias("word"))
    # At most 63 * 24 substrings per piece.
    known = substrings.join(counts, "word").groupBy("piece").agg(
        F.collect_list(F.struct("start", "size", "n")).alias("known"))
    return pieces.join(known, "piece", "left").mapInArrow(_splitter(total), "piece string, words array<string>")


class Model(NamedTuple):
    """Words of each host, weight of each word (towards blocking), and the weight of the shares of sites."""

    hosts: DataFrame  # host, words
    weights: DataFrame  # word, weight
    prior: int


def host_words(spark: SparkSession, hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``host`` and the ``words`` of its name in order, for distinct hosts."""
    placed = hosts.select("host", F.posexplode(name_pieces(F.col("host"))).alias("place", "piece"))
    split = stored(spark, split_pieces(spark, placed.select("piece").distinct(), counts), "urls-pieces")
    listed = placed.join(split, "piece").groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct("place", "words"))).alias("parts"))
    return listed.select("host", F.flatten(F.transform("parts", lambda p: p["words"])).alias("words"))


def _weight(bad: Column, good: Column, totals: tuple[int, int, int]) -> Column:
    bad_total, good_total, size = totals
    return F.round(SCALE * (
        F.log((bad + SMOOTHING) / (bad_total + SMOOTHING * size))
        - F.log((good + SMOOTHING) / (good_total + SMOOTHING * size)))).cast("bigint")


def train(spark: SparkSession, pages: DataFrame, listed: Iterable[str] = BLOCK_WORDS) -> Model:
    """Unigram model, words of all hosts, and naive Bayes over all sites of ``pages``."""
    listed = sorted(set(listed))
    counts = stored(spark, word_counts(spark, pages, listed), "urls-words")
    seen = parsed(pages)
    hosts = stored(spark, host_words(spark, seen.select("host").distinct(), counts), "urls-hosts")
    bad = F.arrays_overlap("words", F.array(*map(F.lit, listed)).cast("array<string>"))
    labels = hosts.select("host", bad.alias("bad"))
    of_paths = seen.select("host", F.explode(F.array_distinct(path_words(F.col("path")))).alias("word"))
    tokens = hosts.select("host", F.explode("words").alias("word")).unionByName(of_paths).distinct()
    examples = tokens.join(labels, "host").select("word", F.col("bad").cast("bigint").alias("bad"))
    examples = examples.unionByName(spark.createDataFrame([(w, 1) for w in listed], "word string, bad long"))
    table = stored(spark, examples.groupBy("word").agg(
        F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")), "urls-classes")
    totals = one_row(table.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("bad", "good")), F.count("*")))
    n_bad, n_hosts = one_row(labels.agg(F.count_if("bad"), F.count("*")))
    prior = round(SCALE * (math.log(n_bad + 1) - math.log(n_hosts - n_bad + 1)))
    weighted = table.select("word", _weight(F.col("bad"), F.col("good"), totals).alias("weight"))
    return Model(hosts, stored(spark, weighted, "urls-weights"), prior)


def _sums(keyed: DataFrame, key: str, words: str, weights: DataFrame) -> DataFrame:
    """Sum of the weights of the words of each distinct key, and how many of them have one."""
    return keyed.select(key, F.explode(words).alias("word")).join(weights, "word").groupBy(key).agg(
        F.sum("weight").alias("sum"), F.count("*").alias("known"))


def judged(spark: SparkSession, pages: DataFrame, model: Model, rules: Iterable[Rule]) -> DataFrame:
    """Each row's host, path, fitting rule, verdict, score towards blocking, and the words of its host."""
    rows = parsed(pages).withColumn("path_words", path_words(F.col("path")))
    # Scores of distinct hosts and of distinct lists of path words; rows only look them up.
    by_host = _sums(model.hosts, "host", "words", model.weights).select(
        "host", F.col("sum").alias("host_sum"), F.col("known").alias("host_known"))
    by_path = _sums(rows.select("path_words").distinct(), "path_words", "path_words", model.weights).select(
        "path_words", F.col("sum").alias("path_sum"), F.col("known").alias("path_known"))
    zero = F.lit(0).cast("bigint")
    known = F.coalesce("host_known", zero) + F.coalesce("path_known", zero)
    total = F.coalesce("host_sum", zero) + F.coalesce("path_sum", zero) + F.lit(model.prior)
    chosen = fitting_rule(F.col("host"), F.col("path"), rules)
    found = rows.join(by_host, "host", "left").join(by_path, "path_words", "left").join(model.hosts, "host", "left")
    return found.select(
        "page_id", "host", "path", chosen["pattern"].alias("rule"),
        F.coalesce(chosen["verdict"], F.when((known > 0) & (total > 0), F.lit("block")).otherwise(F.lit("allow")))
        .alias("verdict"),
        (total / SCALE).alias("score"), "words",
    )
