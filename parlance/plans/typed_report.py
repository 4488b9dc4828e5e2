"""Report text -> typed report with token columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parlance import fixed_values as V
from parlance.functions import convert, tokens as tk
from parlance.functions.text import on
from parlance.functions.transcript import bot_texts_of, pieces, user_texts_of

_CONVERSIONS = {
    "date": convert.parse_date,
    "timestamp": convert.parse_timestamp,
    "integer": convert.parse_integer,
    "double": convert.parse_double,
    "string": lambda c: c.cast("string"),
}


def convert_columns(df: DataFrame, types=V.REPORT_TYPES) -> DataFrame:
    """Convert the named columns, in one projection; the others stay as they are.

    Names match in any case. ``feedback`` keeps only its known classes, and
    ``respuesta_feedback`` only goes with one of them.
    """

    def converted(name: str) -> Column:
        kind = types.get(name.lower())
        if name == "feedback" and kind:
            return on(name, convert.in_domain)
        if name == "respuesta_feedback" and kind and "feedback" in df.columns:
            return convert.only_with(F.col(name), F.col("feedback"))
        return on(name, _CONVERSIONS[kind]) if kind else F.col(name)

    return df.select(*[converted(c).alias(c) for c in df.columns])


def _user_tokens(found: Column) -> Column:
    return tk.estimated_tokens_of_all(user_texts_of(found))


def _bot_tokens(found: Column) -> Column:
    return tk.estimated_tokens_of_all(bot_texts_of(found))


def token_columns(df: DataFrame, source: str = "conversacion_completa") -> DataFrame:
    """Add ``token_pregunta`` and ``token_respuesta``; null when the transcript column is missing."""
    if source not in df.columns:
        none = F.lit(None).cast("int")
        return df.withColumns({"token_pregunta": none, "token_respuesta": none})
    # Both counts read the same pieces, which are cut once.
    return df.withColumn("_pieces", on(source, pieces)).withColumns({
        "token_pregunta": on("_pieces", _user_tokens),
        "token_respuesta": on("_pieces", _bot_tokens),
    }).drop("_pieces")


def as_text(report: DataFrame) -> DataFrame:
    """Every column as text with blanks as null, the way a CSV scan reads the report."""
    return report.select(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in report.columns])


def typed_report(report_text: DataFrame) -> DataFrame:
    """Report read as text -> typed report with token columns."""
    return token_columns(convert_columns(report_text))


def null_profile(df: DataFrame) -> DataFrame:
    """``columna, tipo, validos, nulos`` of every column, in one pass over the data."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    lines = F.array(*[
        F.struct(
            F.lit(name).alias("columna"), F.lit(kind).alias("tipo"), F.col(f"`{name}`").alias("validos"),
            (F.col("_rows") - F.col(f"`{name}`")).alias("nulos"),
        )
        for name, kind in df.dtypes
    ])
    return counts.select(F.inline(lines))
