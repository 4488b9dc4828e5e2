"""One row per user from rows per conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from parlance import fixed_values as V

TEXT_COLUMNS = (
    "conversacion_completa", "feedback_total", "pregunta_conversacion", "feedback", "respuesta_feedback",
)
# What one row of Spark can hold. A longer text ends the job; it never changes the shape of the report.
ROW_BYTES = (1 << 31) - (1 << 20)
# Text of a user that is put together at once where texts are joined in blocks.
BLOCK_BYTES = 16 << 20
# Conversations before other rows, each in key order.
ORDER = ("is_other", "SK", "PK")


def _written(value: Column) -> Column:
    return value.isNotNull() & ~value.isin("", "nan", "None")


def first_real(value: Column, order: Column, default: str, also_default: bool = False) -> Column:
    """First written value in order, else the default text.

    ``also_default=False`` skips values equal to the default as well.
    """
    real = _written(value) if also_default else _written(value) & (value != default)
    return F.coalesce(F.min_by(F.when(real, value), F.when(real, order)), F.lit(default))


def first_other_than(value: Column, order: Column, default: str) -> Column:
    """First value that differs from the default, else the first value."""
    other = value != default
    return F.coalesce(F.min_by(F.when(other, value), F.when(other, order)), F.min_by(value, order))


def join_written(values: Column, separator: str) -> Column:
    """Join the written values of an array."""
    return F.array_join(F.filter(values, _written), separator)


def ordered_rows(*columns: str, order=ORDER) -> Column:
    """Aggregate: the named columns of a group's rows as an array in order."""
    return F.sort_array(F.collect_list(F.struct(*order, *columns)))


def column_of(rows: str | Column, name: str) -> Column:
    """One column of an array of rows."""
    return F.transform(rows, lambda row: row[name])


def text_bytes(*columns: str) -> Column:
    """Aggregate: bytes of the named text columns of a group."""
    return F.sum(row_bytes_of(*columns))


def bounded_rows(key: str, size: str, rows: str) -> Column:
    """The rows of a group, or an error if their text cannot be one row of a report."""
    message = F.concat(
        F.lit("the text of "), F.coalesce(F.col(key), F.lit("null")), F.lit(" has "), F.col(size).cast("string"),
        F.lit(f" bytes and a row holds at most {ROW_BYTES}; read conversation_report instead, which has a row per "
              "conversation"),
    )
    return F.when(F.col(size) <= ROW_BYTES, F.col(rows)).otherwise(F.raise_error(message))


def ordered_concat(rows: DataFrame, key: str, column: str, order: list[str], separator: str) -> DataFrame:
    """``key, column``: written values joined in order, one row per key.

    The rows of a key are collected on the map side first, so a key sends one
    list per task. Key and order together must be unique.
    """
    return rows.groupBy(key).agg(ordered_rows(column, order=order).alias("_rows")).select(
        key, join_written(column_of("_rows", column), separator).alias(column)
    )


def refuse_oversized(rows: DataFrame, key: str, size: str, row_bytes: int = ROW_BYTES) -> None:
    """End with a message if the text of a key is more than a row can hold. Only keys and sizes are read."""
    large = rows.groupBy(key).agg(F.sum(size).alias("n")).where(F.col("n") > row_bytes).orderBy(F.desc("n")).limit(5)
    if found := [f"{r[0]} has {r[1]} bytes" for r in large.collect()]:
        raise ValueError(
            f"the text of {', '.join(found)} and a row holds at most {row_bytes}; read conversation_report instead, "
            "which has a row per conversation")


def concat_in_blocks(
    rows: DataFrame, key: str, columns: tuple[str, ...], order: tuple[str, ...], size: str, separator: str,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``key`` and ``columns``: written values joined in order, one row per key, by way of blocks.

    ``rows`` is a written table with the bytes of each row in ``size``; ``key``
    and ``order`` are unique. Running sums of the narrow columns number the blocks
    of a key. The rows of a block are joined in a task of their own, wherever they
    are, so a key with a third of all rows is spread over many tasks and no buffer
    holds more than ``block_bytes`` and one row. The last step joins whole blocks.
    """
    before = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = rows.select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in order],
        F.floor(F.coalesce(F.sum(size).over(before), F.lit(0)) / block_bytes).alias("_block"))
    same = F.col(key) == F.col("_key")
    for c in order:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    blocks = rows.join(numbered, same).groupBy(key, "_block").agg(ordered_rows(*columns, order=order).alias("_rows"))
    joined = blocks.select(key, "_block", *[join_written(column_of("_rows", c), separator).alias(c) for c in columns])
    whole = joined.groupBy(key).agg(ordered_rows(*columns, order=("_block",)).alias("_blocks"))
    return whole.select(key, *[
        F.array_join(F.filter(column_of("_blocks", c), lambda t: t != ""), separator).alias(c) for c in columns])


def user_rollup_in_blocks(
    rows: DataFrame, separator: str = V.CONVERSATION_SEPARATOR, block_bytes: int = BLOCK_BYTES,
    row_bytes: int = ROW_BYTES, **options,
) -> DataFrame:
    """Same rows as :func:`user_rollup`, from a written table with the bytes of each row's texts in ``_size``.

    A user whose text no row can hold is refused before any text is read.
    """
    rows = rows.where(F.col("usuario_id").isNotNull())
    refuse_oversized(rows, "usuario_id", "_size", row_bytes)
    facts = rows.groupBy("usuario_id").agg(*_facts(**options)).withColumnRenamed("usuario_id", "_user")
    texts = concat_in_blocks(rows, "usuario_id", TEXT_COLUMNS, ORDER, "_size", separator, block_bytes)
    return texts.join(facts, F.col("usuario_id") == F.col("_user")).select(*V.REPORT_COLUMNS)


def row_bytes_of(*columns: str) -> Column:
    """Bytes of the named text columns of a row."""
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c in columns]
    return F.aggregate(F.array(*sizes), F.lit(0).cast("bigint"), lambda total, n: total + n)


def user_rollup(rows: DataFrame, separator: str = V.CONVERSATION_SEPARATOR, **options) -> DataFrame:
    """Per-conversation rows -> one row per user. Rows without a user id are dropped.

    ``options`` are those of the facts: ``area_default``, ``notebook_areas`` and
    ``earliest``, which takes the smallest date instead of the first row's date and
    needs a ``dia`` date column.
    """
    rows = rows.where(F.col("usuario_id").isNotNull())
    grouped = rows.groupBy("usuario_id").agg(
        *_facts(**options),
        text_bytes(*TEXT_COLUMNS).alias("_bytes"),
        ordered_rows(*TEXT_COLUMNS).alias("_rows"),
    )
    rows_of_user = bounded_rows("usuario_id", "_bytes", "_rows")
    texts = {c: join_written(column_of(rows_of_user, c), separator) for c in TEXT_COLUMNS}
    return grouped.withColumns(texts).select(*V.REPORT_COLUMNS)


def _facts(
    area_default: str = V.UNSPECIFIED_AREA, notebook_areas: bool = False, earliest: bool = False,
) -> list[Column]:
    """Aggregates: what is known of a user beside the texts."""
    order = F.struct(*ORDER)
    area = first_other_than if notebook_areas else (
        lambda value, order, default: first_real(value, order, default, also_default=True)
    )
    if earliest:
        day = F.coalesce(F.date_format(F.min("dia"), V.REPORT_DATE_FORMAT), F.lit(V.NO_DATE))
    else:
        day = F.min_by("fecha_primera_conversacion", order)
    return [
        first_real(F.col("nombre"), order, V.ANONYMOUS_NAME).alias("nombre"),
        area(F.col("gerencia"), order, area_default).alias("gerencia"),
        area(F.col("ciudad"), order, area_default).alias("ciudad"),
        day.alias("fecha_primera_conversacion"),
        F.sum("numero_conversaciones").alias("numero_conversaciones"),
        F.sum("numero_feedback").alias("numero_feedback"),
    ]
