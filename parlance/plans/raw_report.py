"""The user report on conversations as stored, without transcripts.

The exploratory form of the report: texts stay as they are, questions come from
the messages themselves, areas keep what is in parentheses, the dates have no
end, and one separator joins everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from parlance import fixed_values as V
from parlance.functions import convert, feedback as fb, text as tx
from parlance.functions.transcript import json_questions
from parlance.operators.feedback_join import apply_last_feedback, last_feedback, report_rows
from parlance.operators.items import drop_register
from parlance.operators.rollup import ORDER
from parlance.plans.user_report import keep_report_rows, rollup_conversations


def raw_conversation_rows(items: DataFrame, start: str = V.REPORT_START) -> DataFrame:
    """One row per conversation with the stored text."""
    rows = keep_report_rows(report_rows(items), start, None, area_default=V.UNSPECIFIED_AREA, clean=False)
    rows = apply_last_feedback(rows.drop("UserData", "CreatedAt"), last_feedback(items))
    rows = rows.withColumn("_flat", fb.flatten_feedback(F.col("Feedback")))
    return rows.select(
        *ORDER, "usuario_id", "nombre", "gerencia", F.col("gerencia").alias("ciudad"),
        convert.date_label(F.col("dia")).alias("fecha_primera_conversacion"), "dia",
        tx.turn_count(F.col("Conversation"), floor=None).cast("bigint").alias("numero_conversaciones"),
        F.col("Conversation").alias("conversacion_completa"),
        F.col("_flat.feedback_total").alias("feedback_total"),
        fb.feedback_count(F.col("_flat.feedback_total")).cast("bigint").alias("numero_feedback"),
        json_questions(F.col("Conversation")).alias("pregunta_conversacion"),
        F.col("_flat.tipo").alias("feedback"), F.col("_flat.comentario").alias("respuesta_feedback"),
    )


def raw_user_report(items: DataFrame, start: str = V.REPORT_START) -> DataFrame:
    """Items -> one row per user with the 12 report columns."""
    rows = raw_conversation_rows(drop_register(items), start)
    return rollup_conversations(
        rows, separator=V.PART_SEPARATOR, area_default=V.UNSPECIFIED_AREA, notebook_areas=True
    )
