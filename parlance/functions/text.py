"""Plain text expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column, functions as F

from parlance import fixed_values as V


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


_BUILT: dict[tuple, Column] = {}


def on(name: str, function: Callable[..., Column], *args) -> Column:
    """``function`` of the named column, built once per process.

    A long expression takes thousands of calls to the JVM to build. It names its
    column but belongs to no table, so every plan can use the same one.
    """
    key = (id(SparkContext._active_spark_context._gateway), function, name, args)
    if key not in _BUILT:
        _BUILT[key] = function(F.col(name), *args)
    return _BUILT[key]


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(text, F.lit(V.WHITESPACE))


def is_blank(text: Column, words=V.BLANK_WORDS) -> Column:
    """Null, empty, or one of the words that stand for "no value"."""
    return text.isNull() | F.lower(strip(text)).isin("", *words)


def is_blank_exact(text: Column, words=V.BLANK_WORDS_EXACT) -> Column:
    """Like :func:`is_blank`, but the words count only as written."""
    return text.isNull() | strip(text).isin("", *words)


def occurrences(text: Column, word: str) -> Column:
    """Number of times a fixed word occurs, without overlaps."""
    # Byte lengths are stored with the text, so no pass over it is needed to count.
    removed = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(word), F.lit("")))
    return (removed / F.lit(len(word.encode()))).cast("int")


def normalize_text(text: Column) -> Column:
    """One line, single spaces, one space on each side of every pipe."""
    flat = text
    for mark in ("\n", "\r", "\t"):
        flat = F.replace(flat, F.lit(mark), F.lit(" "))
    flat = F.regexp_replace(flat, " {2,}", " ")

    def with_pipes(line: Column) -> Column:
        # Neighbouring separators end as one.
        spaced = F.replace(line, F.lit("|"), F.lit(" | "))
        return F.when(
            F.contains(line, F.lit("||")), F.regexp_replace(spaced, r" \|(?:  \|)+ ", " | ")
        ).otherwise(spaced)

    return F.coalesce(strip(bind(flat, with_pipes)), F.lit(""))


def turn_count(transcript: Column, floor: int | None = 1) -> Column:
    """Turns of a transcript: the larger count of "bot" and "user", at least ``floor``.

    A missing transcript counts as one turn. ``floor=None`` leaves a text
    without either word at zero.
    """
    counts = F.greatest(occurrences(transcript, "bot"), occurrences(transcript, "user"))
    if floor is None:
        return F.when(transcript.isNull(), F.lit(1)).otherwise(counts)
    return F.greatest(counts, F.lit(floor))


def has_many(text: Column) -> Column:
    """Does the text hold more than one piece, that is, a pipe?"""
    return F.coalesce(F.contains(text, F.lit("|")), F.lit(False))


def preview(text: Column, size: int) -> Column:
    """The first ``size`` characters, marked with dots when cut."""
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("..."))).otherwise(text)


def distinct_pieces(text: Column, separator: str = V.PART_SEPARATOR) -> Column:
    """Drop blank and repeated pieces of a separated list, keeping first order."""
    pieces = F.transform(split_on(text, separator), strip)
    kept = F.array_distinct(F.filter(pieces, lambda p: p != ""))
    return F.coalesce(F.array_join(kept, separator), F.lit(""))


def split_on(text: Column, separator: str) -> Column:
    """Split on a fixed separator."""
    return F.split(text, "\\Q" + separator + "\\E", -1)


def fill_blank(text: Column, default: str, words=V.BLANK_WORDS_EXACT[:1]) -> Column:
    """Replace a missing or blank value by a default text."""
    return F.when(text.isNull() | text.isin("", *words), F.lit(default)).otherwise(text)
