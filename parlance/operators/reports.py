"""Profiles, distributions, KPIs and samples of the user report, which has one row per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from parlance import fixed_values as V
from parlance.functions.text import has_many, split_on

_WHOLE = "decimal(19,0)"


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name) != "", F.lit(False))


def _percent(part: Column, whole: Column, places: int) -> Column:
    """Share in percent, rounded exactly; null for an empty whole."""
    share = part.cast(_WHOLE) * 100 / F.nullif(whole, F.lit(0)).cast(_WHOLE)
    return F.round(share, places).cast("double")


RUN_COUNTS = (
    "usuarios_procesados", "total_conversaciones", "usuarios_con_feedback", "usuarios_con_preguntas",
    "usuarios_con_respuestas",
)


def run_counts() -> list[Column]:
    """The aggregates of :func:`run_stats`, to be observed while a report is written."""
    values = (
        F.count(F.lit(1)), F.coalesce(F.sum("numero_conversaciones"), F.lit(0)).cast("bigint"),
        F.count_if(_filled("feedback")), F.count_if(_filled("pregunta_conversacion")),
        F.count_if(_filled("respuesta_feedback")),
    )
    return [value.alias(name) for name, value in zip(RUN_COUNTS, values, strict=True)]


def run_stats(report: DataFrame) -> DataFrame:
    """Users, conversations, and users with feedback, questions and answers."""
    return report.agg(*run_counts())


def distinct_users_by_stage(rows: DataFrame, stages: dict[str, Column], key: str = "usuario_id") -> DataFrame:
    """``etapa, usuarios``: users with at least one row in each stage.

    One row per user after map-side combining, instead of one distinct count
    per stage over all rows.
    """
    per_user = rows.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.max(F.coalesce(flag, F.lit(False))).alias(f"_{name}") for name, flag in stages.items()]
    )
    counts = per_user.agg(*[F.count_if(F.col(f"_{name}")).alias(name) for name in stages])
    lines = [F.struct(F.lit(name).alias("etapa"), F.col(name).alias("usuarios")) for name in stages]
    return counts.select(F.inline(F.array(*lines)))


def value_distribution(df: DataFrame, column: str, blank_label: str | None = None, places: int = 1) -> DataFrame:
    """``valor, n, pct`` per value; blanks show as ``blank_label``.

    The total is a scalar subquery over the counts, which shares their exchange:
    the input is read once, partial sums are added up, and no task holds all values.
    """
    value = F.col(column)
    if blank_label is not None:
        value = F.when(F.coalesce(value, F.lit("")) == "", F.lit(blank_label)).otherwise(value)
    counts = df.groupBy(value.alias("valor")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("valor", "n", _percent(F.col("n"), total, places).alias("pct"))


_CLASS_LABELS = {"": V.NO_FEEDBACK, **{name: name for name in V.FEEDBACK_CLASSES}}


def _class_counts(column: str = "feedback") -> list[Column]:
    kind = F.coalesce(F.col(column), F.lit(""))
    return [F.count(F.lit(1)).alias("_n"), *[F.count_if(kind == k).alias(label) for k, label in _CLASS_LABELS.items()]]


def _class_lines(one: DataFrame, places: int = 1) -> DataFrame:
    lines = [
        F.struct(
            F.lit(label).alias("valor"), F.col(label).alias("n"), _percent(F.col(label), F.col("_n"), places).alias("pct")
        )
        for label in _CLASS_LABELS.values()
    ]
    return one.select(F.inline(F.array(*lines))).where(F.col("n") > 0)


def feedback_distribution(report: DataFrame, column: str = "feedback", places: int = 1) -> DataFrame:
    """``valor, n, pct``: users per feedback class that occurs, in one pass over the report."""
    return _class_lines(report.agg(*_class_counts(column)), places)


def histogram(df: DataFrame, column: str) -> DataFrame:
    """``valor, n`` per value, in order of value."""
    return df.groupBy(F.col(column).alias("valor")).agg(F.count(F.lit(1)).alias("n")).orderBy("valor")


def feedback_histogram(report: DataFrame) -> DataFrame:
    """``valor, n``: users per number of feedbacks, in order."""
    return histogram(report, "numero_feedback")


def _bucket_names(edges: tuple[int, int]) -> list[str]:
    low, high = edges
    return [f"{low}", f"{low + 1}-{high}", f"{high + 1}+"]


def _bucket_counts(column: str = "numero_conversaciones", edges: tuple[int, int] = (1, 5)) -> list[Column]:
    low, high = edges
    n = F.col(column)
    tests = (n == low, (n > low) & (n <= high), n > high)
    mean = F.round(F.sum(n).cast(_WHOLE) / F.count(n).cast(_WHOLE), 2).cast("double")
    return [*[F.count_if(t).alias(g) for g, t in zip(_bucket_names(edges), tests, strict=True)], mean.alias("promedio")]


def _bucket_lines(one: DataFrame, edges: tuple[int, int] = (1, 5)) -> DataFrame:
    lines = [
        F.struct(F.lit(g).alias("grupo"), F.col(f"`{g}`").alias("n"), F.col("promedio")) for g in _bucket_names(edges)
    ]
    return one.select(F.inline(F.array(*lines)))


def conversation_buckets(report: DataFrame, column: str = "numero_conversaciones", edges=(1, 5)) -> DataFrame:
    """``grupo, n, promedio``: users with 1, 2 to 5, and more conversations, and the mean of all."""
    return _bucket_lines(report.agg(*_bucket_counts(column, edges)), edges)


def duplicate_keys(df: DataFrame, key: str = "usuario_id") -> DataFrame:
    """``key, n`` of the keys with more than one row."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def duplicate_check(df: DataFrame, key: str = "usuario_id") -> DataFrame:
    """One row: number of repeated keys, and whether there are none."""
    return duplicate_keys(df, key).agg(F.count(F.lit(1)).alias("repetidos")).select(
        "repetidos", (F.col("repetidos") == 0).alias("sin_duplicados")
    )


_COMPLETE = ("pregunta_conversacion", "feedback", "respuesta_feedback")


def _complete_counts(columns=_COMPLETE) -> list[Column]:
    return [F.count(F.lit(1)).alias("_n"), *[F.count_if(_filled(c)).alias(c) for c in columns]]


def _complete_lines(one: DataFrame, columns=_COMPLETE) -> DataFrame:
    lines = [
        F.struct(F.lit(c).alias("columna"), F.col(c).alias("llenos"), _percent(F.col(c), F.col("_n"), 1).alias("pct"))
        for c in columns
    ]
    return one.select(F.inline(F.array(*lines)))


def completeness(report: DataFrame, columns=_COMPLETE) -> DataFrame:
    """``columna, llenos, pct``: users with a value, per column."""
    return _complete_lines(report.agg(*_complete_counts(columns)), columns)


def answer_pieces(report: DataFrame, column: str = "respuesta_feedback") -> DataFrame:
    """``usuario_id, respuesta``: each answer of a user once."""
    return report.where(_filled(column)).select(
        "usuario_id", F.explode(split_on(F.col(column), V.PART_SEPARATOR)).alias("respuesta")
    ).distinct()


def answer_vocabulary(report: DataFrame) -> DataFrame:
    """Number of answers, and of different answers."""
    counts = answer_pieces(report).groupBy("respuesta").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"), F.count(F.lit(1)).alias("distintas")
    )


def top_answers(report: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent answers; ties in text order."""
    counts = answer_pieces(report).groupBy("respuesta").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("respuesta")).limit(k)


def _shape_counts() -> list[Column]:
    answered = _filled("respuesta_feedback")
    return [
        F.count_if(answered).alias("con_respuesta"), F.count_if(~answered).alias("sin_respuesta"),
        F.count_if(has_many(F.col("respuesta_feedback"))).alias("con_multiples"),
    ]


def answer_shape(report: DataFrame) -> DataFrame:
    """Users with an answer, without one, and with several."""
    return report.agg(*_shape_counts())


def _coherence_counts() -> list[Column]:
    return [
        F.count_if(_filled("respuesta_feedback")).alias("con_respuesta"),
        F.count_if(_filled("feedback_total")).alias("con_feedback"),
    ]


def coherence(report: DataFrame) -> DataFrame:
    """Users with an extracted answer against users with any feedback text."""
    return report.agg(*_coherence_counts())


def _validation_counts() -> list[Column]:
    day, n = F.col("fecha_primera_conversacion"), F.col("numero_conversaciones")
    return [
        F.count(F.lit(1)).alias("total_usuarios"), F.min(day).alias("fecha_min"), F.max(day).alias("fecha_max"),
        F.avg(n).alias("promedio_conversaciones"),
    ]


def validation_report(typed: DataFrame) -> DataFrame:
    """Users, first and last date, mean conversations of the typed report."""
    return typed.agg(*_validation_counts())


def _kpi_counts() -> list[Column]:
    return [
        F.count("usuario_id").alias("users"),
        F.sum("numero_conversaciones").cast("bigint").alias("conversations"),
    ]


def _kpi_lines(one: DataFrame) -> DataFrame:
    return one.select(F.inline(F.array(
        F.struct(F.lit("Total Usuarios").alias("metrica"), F.col("users").alias("valor")),
        F.struct(F.lit("Total Conversaciones").alias("metrica"), F.col("conversations").alias("valor")),
    )))


def kpis(report: DataFrame) -> DataFrame:
    """``metrica, valor``: users and conversations, in one scan."""
    return _kpi_lines(report.agg(*_kpi_counts()))


# The reports that are a few counts over all users: their counts, and the lines made of them.
_SUMMARIES = {
    "run_stats": (run_counts, None),
    "feedback_distribution": (_class_counts, _class_lines),
    "conversation_buckets": (_bucket_counts, _bucket_lines),
    "completeness": (_complete_counts, _complete_lines),
    "answer_shape": (_shape_counts, None),
    "coherence": (_coherence_counts, None),
    "validation_report": (_validation_counts, None),
    "kpis": (_kpi_counts, _kpi_lines),
}


def summary(report: DataFrame) -> DataFrame:
    """The counts of all these reports as one row, one struct per report, from a single pass."""
    return report.agg(*[F.struct(*counts()).alias(name) for name, (counts, _) in _SUMMARIES.items()])


def summary_tables(counts: DataFrame) -> dict[str, DataFrame]:
    """The reports by name, from the row of :func:`summary`."""
    tables = {name: counts.select(f"{name}.*") for name in _SUMMARIES}
    return {name: lines(tables[name]) if lines else tables[name] for name, (_, lines) in _SUMMARIES.items()}


def first_rows(df: DataFrame, n: int, order: str = "usuario_id", where: Column | None = None) -> DataFrame:
    """The first n rows in key order that meet a condition."""
    return (df if where is None else df.where(where)).orderBy(order).limit(n)


def rows_per_class(df: DataFrame, class_column: str, n: int, order: str = "usuario_id") -> DataFrame:
    """The first n rows of each class in key order.

    The limit on the row number is applied before the shuffle as well, so a
    frequent class sends at most n rows per task.
    """
    ranked = Window.partitionBy(class_column).orderBy(order)
    return df.withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") <= n).drop("_n")
