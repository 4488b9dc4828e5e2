"""Items -> one row per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parlance import fixed_values as V
from parlance.functions import convert, feedback as fb, text as tx
from parlance.functions.profile import parse_profile
from parlance.functions.questions import user_questions
from parlance.functions.transcript import transcript
from parlance.operators.contract import enforce_columns
from parlance.operators.feedback_join import apply_last_feedback, last_feedback, report_rows
from parlance.operators.items import (
    drop_register, exclude_places, in_day_range, unwrap_items,
)
from parlance.operators.parsing import with_fields
from parlance.operators.rollup import (
    ORDER, TEXT_COLUMNS, bounded_rows, column_of, first_real, join_written, ordered_rows, row_bytes_of, text_bytes,
    user_rollup, user_rollup_in_blocks,
)
from parlance.session import new_folder

RAW_CELLS = ("UserData", "CreatedAt", "Conversation")


def profile_and_dates(rows: DataFrame, clean: bool = True) -> DataFrame:
    """Add ``nombre``, ``gerencia`` and ``dia`` from the raw cells."""
    rows = with_fields(rows, tx.on("UserData", parse_profile, clean))
    return rows.withColumnRenamed("ciudad", "gerencia").withColumn("dia", tx.on("CreatedAt", convert.to_day))


def keep_report_rows(
    rows: DataFrame,
    start: str = V.REPORT_START,
    as_of: str | None = None,
    places=V.EXCLUDED_PLACES,
    area_default: str = V.DEFAULT_AREA,
    clean: bool = True,
) -> DataFrame:
    """Rows inside the places and dates of the report, with default texts filled in."""
    rows = exclude_places(profile_and_dates(rows, clean), "gerencia", places)
    rows = rows.where(in_day_range(F.col("dia"), start, as_of))
    return rows.withColumns({
        "nombre": tx.fill_blank(F.col("nombre"), V.ANONYMOUS_NAME),
        "gerencia": tx.fill_blank(F.col("gerencia"), area_default, words=()),
    })


def conversation_texts(rows: DataFrame) -> DataFrame:
    """Add transcript, date text, turn count and user questions."""
    rows = rows.withColumn("conversacion_completa", tx.on("Conversation", transcript))
    return rows.withColumns({
        "fecha_primera_conversacion": tx.on("dia", convert.date_label),
        "numero_conversaciones": tx.on("conversacion_completa", tx.turn_count),
        "pregunta_conversacion": tx.on("conversacion_completa", user_questions),
    })


def conversation_report(items: DataFrame, list_mode: str = "all", **limits) -> DataFrame:
    """One row per conversation with the 12 report columns and the order columns.

    This is also the long form of the report, for consumers that do not need one
    row per user: it has the same shape for every user.
    """
    items = drop_register(items)

    def unwrapped(winners: DataFrame) -> DataFrame:
        return unwrap_items(winners, ("Feedback",), list_mode)

    feedback = last_feedback(items, unwrapped)
    items = unwrap_items(items, ("Feedback", "CreatedAt"), list_mode)
    # Filtered and turned into texts first, so the join moves no raw cells.
    rows = conversation_texts(keep_report_rows(report_rows(items), **limits)).drop(*RAW_CELLS)
    rows = apply_last_feedback(rows, feedback)
    rows = rows.withColumn("_flat", tx.on("Feedback", fb.flatten_feedback))
    return rows.select(
        *ORDER,
        "usuario_id", "nombre", "gerencia", F.col("gerencia").alias("ciudad"),
        "fecha_primera_conversacion", "dia",
        F.col("numero_conversaciones").cast("bigint").alias("numero_conversaciones"),
        "conversacion_completa",
        F.col("_flat.feedback_total").alias("feedback_total"),
        tx.on("_flat.feedback_total", fb.feedback_count).cast("bigint").alias("numero_feedback"),
        "pregunta_conversacion",
        F.col("_flat.tipo").alias("feedback"),
        F.col("_flat.comentario").alias("respuesta_feedback"),
    )


def _distinct_answers(feedback: Column) -> Column:
    return tx.distinct_pieces(fb.feedback_answers(feedback))


def classify_report(report: DataFrame) -> DataFrame:
    """Replace ``feedback`` and ``respuesta_feedback`` by what the whole feedback text says."""
    return report.withColumns({
        "feedback": tx.on("feedback_total", fb.feedback_class),
        "respuesta_feedback": tx.on("feedback_total", _distinct_answers),
    })


def rollup_conversations(rows: DataFrame, **options) -> DataFrame:
    """Per-conversation report rows -> classified user report."""
    return enforce_columns(classify_report(user_rollup(rows, **options)))


def user_report_in_blocks(items: DataFrame, list_mode: str = "all", limits: dict | None = None, **options) -> DataFrame:
    """Same rows as :func:`user_report`, for tables in which a user may have more text than a task should hold.

    The rows per conversation are written to the shared folder once. Sizes are
    summed from their narrow columns before any text moves, and texts are joined
    in blocks. This moves every text three times, where :func:`user_report` moves
    it once and collects a user's texts in one buffer.
    """
    spark = items.sparkSession
    rows = conversation_report(items, list_mode, **(limits or {})).withColumn("_size", row_bytes_of(*TEXT_COLUMNS))
    folder = new_folder(spark, "conversations")
    rows.write.parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder)
    return enforce_columns(classify_report(user_rollup_in_blocks(rows, **options)))


def _feedback_cells(cell: Column) -> Column:
    total = fb.flatten_feedback(cell)["feedback_total"]
    return tx.bind(total, lambda t: F.struct(
        t.alias("total"), fb.feedback_count(t).cast("bigint").alias("n")
    ))


def _user_facts() -> list[Column]:
    order = F.struct(*ORDER)
    return [
        first_real(F.col("nombre"), order, V.ANONYMOUS_NAME).alias("nombre"),
        first_real(F.col("gerencia"), order, V.UNSPECIFIED_AREA, also_default=True).alias("gerencia"),
        F.min_by("fecha_primera_conversacion", order).alias("fecha_primera_conversacion"),
    ]


def user_report(
    items: DataFrame, list_mode: str = "all", separator: str = V.CONVERSATION_SEPARATOR, **limits,
) -> DataFrame:
    """Items -> one row per user with the 12 report columns, whatever the size of a user.

    Same result as rolling up :func:`conversation_report`, with less data moved:
    rows are filtered and turned into texts before the only shuffle they take,
    and the user's last feedback is joined to the grouped row, on the same key,
    instead of being copied onto every conversation first. Facts and sums
    combine on the map side, and so do the lists of texts. The plan does not
    depend on the data. A user whose text does not fit a row of Spark ends the
    job with a message that says so.
    """
    items = drop_register(items)

    def cells(winners: DataFrame) -> DataFrame:
        return unwrap_items(winners, ("Feedback",), list_mode).withColumn(
            "Feedback", tx.on("Feedback", _feedback_cells))

    feedback = last_feedback(items, cells)
    rows = report_rows(unwrap_items(items, ("Feedback", "CreatedAt"), list_mode)).where(F.col("usuario_id").isNotNull())
    rows = conversation_texts(keep_report_rows(rows, **limits))
    rows = rows.withColumn("own", F.when(F.col("Feedback").isNotNull(), tx.on("Feedback", _feedback_cells)))

    grouped = rows.groupBy("usuario_id").agg(
        *_user_facts(),
        F.sum("numero_conversaciones").cast("bigint").alias("numero_conversaciones"),
        text_bytes("conversacion_completa", "pregunta_conversacion", "own.total").alias("_bytes"),
        ordered_rows("conversacion_completa", "pregunta_conversacion", "own").alias("_rows"),
    )
    joined = grouped.join(feedback, "usuario_id", "left").withColumn(
        "_rows", bounded_rows("usuario_id", "_bytes", "_rows"))

    def cells_of(row: Column) -> Column:
        winner = F.try_element_at(F.col("last_feedback"), row["PK"])
        return F.when(winner.isNotNull() & ~row["is_other"], winner["Feedback"]).otherwise(row["own"])

    report = joined.withColumn("_cells", F.transform("_rows", cells_of)).select(
        "usuario_id", "nombre", "gerencia", F.col("gerencia").alias("ciudad"),
        "fecha_primera_conversacion", "numero_conversaciones",
        join_written(column_of("_rows", "conversacion_completa"), separator).alias("conversacion_completa"),
        join_written(column_of("_cells", "total"), separator).alias("feedback_total"),
        F.aggregate(
            "_cells", F.lit(0).cast("bigint"), lambda n, c: n + F.coalesce(c["n"], F.lit(0))
        ).alias("numero_feedback"),
        join_written(column_of("_rows", "pregunta_conversacion"), separator).alias("pregunta_conversacion"),
    )
    return enforce_columns(classify_report(report))
