"""Feedback text: counting, classifying and reading the answers inside it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parlance import fixed_values as V
from parlance.functions.envelope import collapse_list, unwrap_any, unwrap_text
from parlance.functions.literal import as_list, as_map, field, field_text, read_json, read_value
from parlance.functions.text import bind, is_blank, occurrences, split_on, strip

_S = f"[{V.WHITESPACE_CLASS}]"
_MIN_FREE_TEXT = 10


def _values_of(text: Column, key: str, quote: str, value_quote: str | None = None) -> Column:
    value_quote = value_quote or quote
    pattern = rf"{quote}{key}{quote}:{_S}*{value_quote}([^{value_quote}]*){value_quote}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _is_list(text: Column) -> Column:
    return F.startswith(text, F.lit("[")) & F.endswith(text, F.lit("]"))


def _is_object(text: Column) -> Column:
    return F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}"))


def feedback_count(feedback: Column) -> Column:
    """Likes and dislikes in the text; a longer text without either counts as one."""
    text = strip(feedback)
    marks = bind(F.lower(text), lambda t: F.aggregate(
        F.array(*[occurrences(t, m) for m in V.FEEDBACK_MARKS]), F.lit(0), lambda total, n: total + n
    ))
    free_text = F.when(F.length(text) > _MIN_FREE_TEXT, F.lit(1)).otherwise(F.lit(0))
    return F.when(is_blank(feedback), F.lit(0)).otherwise(F.coalesce(F.nullif(marks, F.lit(0)), free_text))


def _class_of(types: Column) -> Column:
    """``like``, ``dislike``, ``mixed``, or null when the array names neither."""

    def of(found: Column) -> Column:
        has_like, has_dislike = F.array_contains(found, "like"), F.array_contains(found, "dislike")
        return (
            F.when(has_like & has_dislike, "mixed").when(has_like, "like").when(has_dislike, "dislike")
        )

    return bind(F.transform(types, lambda t: strip(F.lower(t))), of)


def feedback_class(feedback: Column) -> Column:
    """``like``, ``dislike``, ``mixed`` or ``''``."""
    text = strip(feedback)
    types = F.concat(_values_of(text, "type", "'"), _values_of(text, "type", '"'))
    value = F.when(_is_list(text) | _is_object(text), read_value(text))
    objects = bind(value, lambda v: F.coalesce(as_list(v), F.when(as_map(v).isNotNull(), F.array(v))))
    read_types = F.transform(objects, lambda o: field_text(o, "type"))
    return F.when(is_blank(feedback), F.lit("")).otherwise(
        F.coalesce(_class_of(types), _class_of(F.filter(read_types, lambda t: t.isNotNull())), F.lit(""))
    )


def feedback_answers(feedback: Column, mixed_quotes: bool = True) -> Column:
    """Comments, then options, joined in order.

    ``mixed_quotes`` also reads values in double quotes under a key in single
    quotes, the way a literal writes a text with an apostrophe.
    """
    text = strip(feedback)

    def found(key: str) -> list[Column]:
        forms = [_values_of(text, key, "'"), _values_of(text, key, '"')]
        if mixed_quotes:
            forms.append(_values_of(text, key, "'", '"'))
        return forms

    def useful(values: Column) -> Column:
        return F.filter(F.transform(values, strip), lambda v: ~F.lower(v).isin("", "none", "null"))

    quoted = useful(F.concat(*found("comment"), *found("option")))
    parts = F.filter(F.transform(split_on(text, "|"), strip), _is_object)
    objects = F.transform(parts, lambda p: read_value(p))
    members = F.flatten(
        F.transform(objects, lambda o: F.filter(
            F.array(field_text(o, "comment"), field_text(o, "option")), lambda v: v.isNotNull()
        ))
    )

    def joined(answers: Column) -> Column:
        return F.nullif(F.array_join(answers, V.PART_SEPARATOR), F.lit(""))

    return F.when(is_blank(feedback), F.lit("")).otherwise(
        F.coalesce(joined(quoted), joined(useful(members)), F.lit(""))
    )


def flatten_feedback(feedback: Column) -> Column:
    """Feedback text -> ``struct<feedback_total, tipo, comentario, campos>``.

    ``campos`` maps every key of a JSON object to its text; ``{"S": x}`` reads as x.
    """
    text = F.coalesce(strip(feedback), F.lit(""))
    members = F.when(_is_object(text), as_map(read_json(text)))
    fields = F.transform_values(
        members, lambda _, v: F.coalesce(field_text(v, "S"), F.try_variant_get(v, "$", "string"))
    )

    def columns(found: Column) -> Column:
        def member(name: str, default: Column) -> Column:
            return F.coalesce(F.try_element_at(found, F.lit(name)), default)

        return F.struct(
            member("feedback_total", text).alias("feedback_total"),
            member("tipo", F.lit("")).alias("tipo"),
            member("comentario", F.lit("")).alias("comentario"),
            found.alias("campos"),
        )

    return bind(fields, columns)


def _object_text(value: Column) -> Column:
    # One space after colons and commas, the spelling the counters look for.
    entries = F.map_entries(as_map(F.coalesce(field(value, "M"), value)))
    pairs = F.transform(
        entries,
        lambda e: F.concat(
            F.lit('"'), e["key"], F.lit('": '),
            F.coalesce(F.to_json(unwrap_any(e["value"])), F.lit("null")),
        ),
    )
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


def unwrap_feedback(feedback: Column, list_mode: str = "all") -> Column:
    """Feedback cell -> feedback text.

    An envelope becomes the text of its content; text that is no envelope stays
    as it is. ``list_mode='first'`` keeps only the first entry of a list.
    """
    text = strip(feedback)
    value = F.when(_is_object(text) | _is_list(text), read_json(text))

    def rendered(v: Column) -> Column:
        items = F.coalesce(as_list(field(v, "L")), as_list(v))
        texts = F.transform(items, _object_text)
        listed, is_listed = collapse_list(texts, list_mode), items.isNotNull()
        if list_mode == "all":
            listed = F.concat(F.lit("["), F.array_join(texts, ", "), F.lit("]"))
            is_listed = field(v, "L").isNotNull()
        return (
            F.when(v.isNull(), feedback)
            .when(field(v, "S").isNotNull() | field(v, "NULL").isNotNull(), unwrap_text(v))
            .when(is_listed, listed)
            .when(field(v, "M").isNotNull(), _object_text(v))
            .otherwise(feedback)
        )

    return bind(value, rendered)
