"""Items -> messages per conversation and per user.

The turn count of the user report counts words, also inside texts; here whole
messages count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from parlance.functions import text as tx
from parlance.functions.transcript import message_counts
from parlance.operators.items import drop_register, is_conversation, user_id
from parlance.operators.parsing import with_fields

COUNTS = ("mensajes", "de_usuario", "de_bot", "de_otros")


def conversation_messages(items: DataFrame) -> DataFrame:
    """One row per conversation item: ``usuario_id, SK`` and its messages by who wrote them.

    A conversation that cannot be read has nulls. Items of other kinds and
    registrations are left out.
    """
    rows = drop_register(items).where(is_conversation()).select(
        user_id(F.col("PK")).alias("usuario_id"), "SK", "Conversation")
    return with_fields(rows, tx.on("Conversation", message_counts)).select(
        "usuario_id", "SK", *(F.col(c).cast("bigint").alias(c) for c in COUNTS))


def message_report(items: DataFrame) -> DataFrame:
    """One row per user: conversations, messages by who wrote them, the longest conversation, and unread conversations.

    Sums and the maximum combine on the map side, so a busy user is one row per
    task and no text is shuffled.
    """
    return conversation_messages(items).groupBy("usuario_id").agg(
        F.count("*").alias("conversaciones"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS),
        F.max("mensajes").alias("maximo"),
        F.count_if(F.col("mensajes").isNull()).alias("sin_leer"),
    )
