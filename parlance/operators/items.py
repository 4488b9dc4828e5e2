"""Filters and keys of the item table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parlance import fixed_values as V
from parlance.functions import convert
from parlance.functions.envelope import open_scalar
from parlance.functions.feedback import unwrap_feedback
from parlance.functions.text import on


def _marked(key: Column, mark: str) -> Column:
    return F.coalesce(F.contains(F.upper(key), F.lit(mark)), F.lit(False))


def is_conversation(key: Column = None) -> Column:
    return _marked(F.col("SK") if key is None else key, V.CONVERSATION_MARK)


def is_feedback(key: Column = None) -> Column:
    return _marked(F.col("SK") if key is None else key, V.FEEDBACK_MARK)


def drop_register(items: DataFrame) -> DataFrame:
    """Drop registration items. Items without a sort key stay."""
    if "SK" not in items.columns:
        return items
    return items.where(~_marked(F.col("SK"), V.REGISTER_MARK))


def with_row_kinds(items: DataFrame) -> DataFrame:
    """Add ``is_conversation``, ``is_feedback`` and ``is_other``."""
    conversation, feedback = is_conversation(), is_feedback()
    return items.withColumns(
        {"is_conversation": conversation, "is_feedback": feedback, "is_other": ~conversation & ~feedback}
    )


def user_id(key: Column) -> Column:
    """User id: the partition key without its prefix."""
    return F.replace(key, F.lit(V.USER_KEY_PREFIX), F.lit(""))


def with_user_id(items: DataFrame) -> DataFrame:
    """Add ``usuario_id`` as the first column."""
    rest = [c for c in items.columns if c != "usuario_id"]
    return items.select(user_id(F.col("PK")).alias("usuario_id"), *rest)


def rename_report_columns(df: DataFrame) -> DataFrame:
    """Item names -> report names."""
    return df.withColumnsRenamed(
        {"CreatedAt": "fecha_primera_conversacion", "Conversation": "conversacion_completa"}
    )


def unwrap_items(items: DataFrame, columns=("UserData", "Feedback", "CreatedAt"), list_mode: str = "all") -> DataFrame:
    """Unwrap the enveloped cells of the named columns; the conversation keeps its form."""
    present = [c for c in columns if c in items.columns]
    return items.withColumns({
        c: on(c, unwrap_feedback, list_mode) if c == "Feedback" else on(c, open_scalar) for c in present
    })


def is_excluded_place(place: Column, words=V.EXCLUDED_PLACES, whole_words: bool = False) -> Column:
    """Does the place name one of the excluded places, in any case?

    The words match anywhere in the text unless ``whole_words`` is set.
    """
    pattern = "|".join(words)
    edge = r"(?U)\b" if whole_words else ""
    return F.coalesce(place.rlike(f"(?iu){edge}(?:{pattern}){edge}"), F.lit(False))


def exclude_places(df: DataFrame, column: str = "gerencia", words=V.EXCLUDED_PLACES, whole_words=False) -> DataFrame:
    """Drop rows of excluded places; a missing place stays."""
    return df.where(~is_excluded_place(F.col(column), words, whole_words))


def in_day_range(day: Column, start: str, end: str | None) -> Column:
    """Inside the range, or without a readable date. ``end=None`` leaves it open."""
    inside = day >= F.lit(start).cast("date")
    if end is not None:
        inside = inside & (day <= F.lit(end).cast("date"))
    return day.isNull() | inside


def in_epoch_range(raw: Column, first_ms: int, last_ms: int) -> Column:
    """Inside the range, or without a usable time."""
    return F.coalesce(convert.epoch_ms(raw).between(first_ms, last_ms), F.lit(True))


def with_any_tokens(tokens: DataFrame) -> DataFrame:
    """Rows of the token table that have input or output tokens."""
    return tokens.where((F.col("input_token") > 0) | (F.col("output_token") > 0))
