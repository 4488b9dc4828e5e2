"""Small documents with everything that may go wrong, and helpers for the tests."""

import re

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Extra columns with names that the operators use inside.
    T.StructField("label", T.StringType()), T.StructField("node", T.StringType()),
    T.StructField("rate", T.DoubleType()), T.StructField("score", T.StringType()),
])

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(WORDS[(i * i + 7 * i) % 397] for i in range(30_000))


def rows(*texts, first=0):
    """Rows of ``(id, text)`` pairs or texts, numbered from ``first``."""
    out = []
    for i, item in enumerate(texts):
        doc_id, text = item if isinstance(item, tuple) else (first + i, item)
        out.append((doc_id, text, "en", "s", None if text is None else len(text), "x", "y", 0.5, "z"))
    return out


ODD = rows(
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "one"), (5, "a b c d"), (6, "a b c d e"), (None, "a b c d e"),
    (7, "A B C D E"), (7, "A B C D E"), (8, LONG), (9, "Ünï cödé 漢字 \U0001F600 text"), (10, "\x00 nul \x7f"),
    (None, None), (11, "...,;!"), (12, "w " * 60),
)


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def folded(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
