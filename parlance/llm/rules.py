"""Quality rules: a threshold table compiled into one projection.

Everything is built from Spark functions over the whole text; there is no user
function, no explode and no shuffle. Words are runs of characters other than
space and the control characters tab to carriage return.

Repeated windows are found inside the row: if the hashes of the three-word
windows are not all different, every window becomes a (window, position) pair,
sorting brings equal windows together, and a window is repeated if it equals a
neighbour. The words covered by repeated windows follow
from the gaps between their sorted positions.

Defined results: a null text counts as a text without words, and fails the base
rule of 50 words, as does an empty one. Ratios of a text without words or lines
are null and fail their rule. Repeated rows get equal results.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# --- Fixed values: frequent words of the four languages ------------------------
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "are",
    "this", "from", "or",
    "der", "die", "und", "den", "von", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein",
    "eine", "als",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur",
    "au", "pas",
    "el", "y", "los", "se", "del", "las", "con", "no", "su", "para", "es", "al", "lo", "como",
)


class Rule(NamedTuple):
    """A ratio that has to lie between two bounds; None leaves a side open."""

    name: str
    low: float | None
    high: float | None


RULES = (
    Rule("chars_per_word", 1.5, 20.0),
    Rule("symbols_per_word", None, 0.20),
    Rule("shouts_per_word", None, 0.50),
    Rule("capital_share", None, 0.50),
    Rule("stop_word_share", 0.05, None),
    Rule("duplicate_line_share", None, 0.50),
    Rule("words_per_line", 1.5, None),
)


MARKS = ".,;:!?()\""
SPACE_CLASS = r"[\x20\x09-\x0D]"


def _split(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE_CLASS}+"), lambda w: w != "")


def _count(text: Column, characters: str) -> Column:
    """How many characters of a class a text holds."""
    return F.regexp_count(text, F.lit(characters)).cast("bigint")


def _places(n: Column) -> Column:
    """Positions of the windows of three words."""
    return F.when(n >= 3, F.sequence(F.lit(0), n.cast("int") - 3)).otherwise(F.array().cast("array<int>"))


def _hashes(words: Column, places: Column) -> Column:
    """A hash of every window: windows that are equal have equal ones."""
    return F.transform(places, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))


def _windows(words: Column, places: Column) -> Column:
    """(Three words, position) of every window. Words hold no space, so the joined form is exact."""
    return F.transform(places, lambda i: F.struct(
        F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("w"), i.alias("i")))


def _repeated(windows: Column) -> Column:
    """Positions of the sorted windows that equal a neighbour, in order."""
    same = F.filter(windows, lambda x, k: F.coalesce(
        (x["w"] == F.get(windows, k - 1)["w"]) | (x["w"] == F.get(windows, k + 1)["w"]),
        x["w"] == F.get(windows, k - 1)["w"], x["w"] == F.get(windows, k + 1)["w"], F.lit(False)))
    return F.sort_array(F.transform(same, lambda x: x["i"]))


def _covered(places: Column) -> Column:
    """Words covered by three-word windows at the given sorted positions."""
    gaps = F.transform(places, lambda p, k: F.least(F.coalesce(F.get(places, k + 1) - p, F.lit(3)), F.lit(3)))
    return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap)


def measures(documents: DataFrame) -> DataFrame:
    """Counts per document. What a later step uses inside a loop is a column of the step before."""
    text = F.col("text")
    plain = F.regexp_replace(F.lower(text), f"[{MARKS}]", "")
    parts = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"),
    ).select(
        "doc_id", "text", _split(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    counted = parts.select(
        "doc_id", "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        _count(text, f"[{SYMBOLS}]").alias("n_symbols"), _count(text, "!").alias("n_shouts"),
        _count(text, "[A-Z]").alias("n_capitals"),
        F.size(F.filter(_split(plain), lambda w: w.isin(*STOP_WORDS))).cast("bigint").alias("n_stop_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
    )
    names = [c for c in counted.columns if c != "words"]
    hashed = counted.select(*names, "words", _places(F.col("n_words")).alias("all_places")).select(
        "*", _hashes(F.col("words"), F.col("all_places")).alias("hashes"))
    # Most texts repeat no window; if no two hashes are equal, no two windows are, and nothing is sorted.
    different = F.size(F.array_distinct("hashes")) == F.size("hashes")
    windows = F.sort_array(_windows(F.col("words"), F.col("all_places")))
    found = hashed.select(*names, F.when(~different, windows).otherwise(
        F.array().cast("array<struct<w:string,i:int>>")).alias("windows"))
    placed = found.select(*names, _repeated(F.col("windows")).alias("places"))
    return placed.select(*names, _covered(F.col("places")).alias("n_repeat_words"))


def ratios() -> dict[str, Column]:
    """The ratios that rules may bound, from the columns of :func:`measures`."""
    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b))

    return {
        "chars_per_word": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "shouts_per_word": share("n_shouts", "n_words"),
        "capital_share": share("n_capitals", "word_chars"),
        "stop_word_share": share("n_stop_words", "n_words"),
        "duplicate_line_share": share("n_dup_lines", "n_lines"),
        "words_per_line": share("n_words", "n_lines"),
    }


def passes(rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one condition; a null ratio fails."""
    values = ratios()
    held = F.lit(True)
    for rule in rules:
        value = values[rule.name]
        if rule.low is not None:
            held = held & F.coalesce(value >= rule.low, F.lit(False))
        if rule.high is not None:
            held = held & F.coalesce(value <= rule.high, F.lit(False))
    return held


def quality_rules(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document: counts, the base verdict, and whether the document is kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))
    return measures(documents).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & passes(rules))


def rules_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same threshold table as a condition for another SQL engine."""
    parts = {
        "chars_per_word": ("word_chars", "n_words"), "symbols_per_word": ("n_symbols", "n_words"),
        "shouts_per_word": ("n_shouts", "n_words"), "capital_share": ("n_capitals", "word_chars"),
        "stop_word_share": ("n_stop_words", "n_words"), "duplicate_line_share": ("n_dup_lines", "n_lines"),
        "words_per_line": ("n_words", "n_lines"),
    }
    out = []
    for rule in rules:
        a, b = parts[rule.name]
        value = f"CAST({a} AS DOUBLE) / nullif({b}, 0)"
        out += [f"coalesce({value} >= {rule.low}, false)"] if rule.low is not None else []
        out += [f"coalesce({value} <= {rule.high}, false)"] if rule.high is not None else []
    return " AND ".join(out)
