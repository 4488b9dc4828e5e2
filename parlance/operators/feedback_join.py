"""The last feedback of a user replaces the feedback of the user's conversations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from parlance.operators.items import is_conversation, is_feedback, user_id


def last_feedback(items: DataFrame, shape: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Last feedback item per partition key, as ``usuario_id, last_feedback map<PK, struct<Feedback>>``.

    ``max_by`` combines on the map side, so a busy user costs one row per task.
    ``shape`` is applied to the winners only, one row per key with the raw
    ``Feedback``, so what loses is never parsed. The struct keeps a null feedback
    apart from no feedback. The map covers the keys that differ only in the user
    prefix, which share one user id.
    """
    winners = items.where(is_feedback() & F.col("PK").isNotNull()).groupBy("PK").agg(
        F.max_by(F.struct("Feedback"), "SK").alias("winner")
    ).select("PK", "winner.Feedback")
    if shape is not None:
        winners = shape(winners)
    return winners.groupBy(user_id(F.col("PK")).alias("usuario_id")).agg(
        F.map_from_entries(F.collect_list(F.struct("PK", F.struct("Feedback").alias("winner")))).alias("last_feedback")
    )


def report_rows(items: DataFrame) -> DataFrame:
    """Conversation and other rows with ``usuario_id`` and ``is_other``; feedback rows are left out.

    A row marked both as conversation and as feedback is a conversation here,
    and a feedback for :func:`last_feedback`.
    """
    return items.where(is_conversation() | ~is_feedback()).withColumns(
        {"usuario_id": user_id(F.col("PK")), "is_other": ~is_conversation()}
    )


def apply_last_feedback(rows: DataFrame, feedback: DataFrame) -> DataFrame:
    """Put the last feedback of the key on the conversations; other rows keep their own.

    The join key is the user id, the key a rollup groups by as well. A busy
    user's rows may be split by the engine's skew handling, since the feedback
    side holds one row per user.
    """
    joined = rows.join(feedback, "usuario_id", "left")
    winner = F.try_element_at("last_feedback", F.col("PK"))
    return joined.withColumn(
        "Feedback",
        F.when(winner.isNotNull() & ~F.col("is_other"), winner["Feedback"]).otherwise(F.col("Feedback")),
    ).drop("last_feedback")


def join_last_feedback(items: DataFrame) -> DataFrame:
    """Conversation and other rows; conversations carry the last feedback of their key.

    Users with nothing but feedback disappear. ``is_other`` marks rows that are
    no conversation; they keep their own feedback and come last in order.
    """
    return apply_last_feedback(report_rows(items), last_feedback(items))
