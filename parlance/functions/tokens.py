"""Token counts of texts, and the reading of message maps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parlance import fixed_values as V
from parlance.functions.cells import WHOLE_BYTES, read_members
from parlance.functions.literal import as_list, as_map, field, is_string, read_json, read_json_object
from parlance.functions.text import bind, strip


def chars4_tokens(text: Column) -> Column:
    """One token per four characters, at least one; none for a missing or empty text."""
    length = F.length(text)
    quarter = F.floor(length / F.lit(4)).cast("int")
    return F.when(F.coalesce(length, F.lit(0)) == 0, F.lit(0)).otherwise(F.greatest(F.lit(1), quarter))


def _class_body(characters: str) -> str:
    return "".join("\\" + c for c in characters)


# Everything below U+0660 that is neither punctuation, nor a digit, nor a symbol.
_PLAIN = "".join(
    chr(i) for i in range(256) if not chr(i).isdigit() and chr(i) not in V.PUNCTUATION + V.SPECIAL
)
_PLAIN_RUN = "[" + "".join(f"\\x{ord(c):02x}" for c in _PLAIN) + "\\u0100-\\u065f]++"
_NOT_PUNCTUATION = f"[^{_class_body(V.PUNCTUATION)}]++"
_NOT_SPECIAL = rf"[^\p{{Nd}}{V.EXTRA_DIGITS_CLASS}{_class_body(V.SPECIAL)}]++"


def estimated_tokens(text: Column) -> Column:
    """Token estimate from length, spaces, punctuation, digits and symbols."""
    return bind(text, _estimate)


def _estimate(text: Column) -> Column:
    chars = F.length(text)
    spaces = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))

    def counts(marks: Column) -> Column:
        # One pass over the text leaves the few characters that the classes look at.
        punctuation = F.length(F.regexp_replace(marks, _NOT_PUNCTUATION, ""))
        special = F.length(F.regexp_replace(marks, _NOT_SPECIAL, ""))
        factor = (
            F.lit(1)
            + spaces / chars * F.lit(V.SPACE_WEIGHT)
            + punctuation / chars * F.lit(V.PUNCTUATION_WEIGHT)
            + special / chars * F.lit(V.SPECIAL_WEIGHT)
        )
        return F.greatest(F.lit(1), F.floor(chars / F.lit(V.CHARS_PER_TOKEN) * factor).cast("int"))

    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0)).otherwise(
        bind(F.regexp_replace(text, _PLAIN_RUN, ""), counts)
    )


def estimated_tokens_of_all(texts: Column) -> Column:
    """Sum of the estimates of an array of texts; each text is rounded on its own."""
    return F.aggregate(F.transform(texts, estimated_tokens), F.lit(0), lambda total, n: total + n)


# --- message maps -------------------------------------------------------------

_STATUS_MISSING, _STATUS_UNREADABLE = "missing", "unreadable"


def _unquoted(text: Column) -> Column:
    quoted = F.startswith(text, F.lit('"')) & F.endswith(text, F.lit('"')) & (F.length(text) > 1)
    return F.when(quoted, F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(text)


def _replaced(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _repaired(text: Column) -> Column:
    """Undo CSV quoting, bare up quoted constants and close truncated bodies."""
    return _replaced(_unquoted(text), *V.MAP_REPAIRS, V.TRUNCATED_BODY)


def _braced(text: Column) -> Column:
    """From the first opening to the last closing brace."""
    return F.nullif(F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.lit(""))


def read_message_map(raw: Column, whole_bytes: int = WHOLE_BYTES) -> Column:
    """Message-map text -> ``struct<value variant, members array<struct<key, value>>, parse_status string>``.

    The text is read as it is first; only when that fails is it repaired, and
    only when that fails is it cut to its braces. ``parse_status`` says which
    step succeeded: ``valid``, ``repaired``, ``cut``, ``unreadable`` or ``missing``.
    A map above ``whole_bytes`` is cut into its members, which stand in ``members``
    in place of a value.
    """
    return bind(strip(raw), lambda text: _read_map(text, whole_bytes))


MEMBERS = "array<struct<key: string, value: variant>>"


def _read_map(text: Column, whole_bytes: int) -> Column:
    present = F.coalesce(text != "", F.lit(False))
    body_closed = _replaced(text, V.TRUNCATED_BODY)

    def tried(candidate: Column, status: str, read=read_json) -> Column:
        return bind(read(candidate), lambda v: F.when(v.isNotNull(), _map_read(v, None, status)))

    def tried_members(candidate: Column, status: str) -> Column:
        return bind(read_members(candidate, whole_bytes), lambda m: F.when(m.isNotNull(), _map_read(None, m, status)))

    failed, missing = _map_read(None, None, _STATUS_UNREADABLE), _map_read(None, None, _STATUS_MISSING)
    return F.when(
        present,
        F.coalesce(
            tried_members(text, "valid"),
            tried_members(body_closed, "repaired"),
            tried(text, "valid"),
            tried(text, "valid", read_json_object),
            tried(body_closed, "repaired"),
            tried(_repaired(text), "repaired"),
            tried(_braced(_repaired(text)), "cut"),
            failed,
        ),
    ).otherwise(missing)


def _map_read(value: Column | None, members: Column | None, status: str) -> Column:
    return F.struct(
        (F.lit(None).cast("variant") if value is None else value).alias("value"),
        (F.lit(None).cast(MEMBERS) if members is None else members).alias("members"),
        F.lit(status).alias("parse_status"),
    )


def _open(value: Column) -> Column:
    """Content of an enveloped value; a value without a tag stays."""
    return F.coalesce(field(value, "S"), field(value, "L"), field(value, "M"), value)


def message_entries(value: Column, enveloped: bool = False, members: Column | None = None) -> Column:
    """Message map -> ``array<struct<message_id, role, body, listed>>``, one per content item.

    ``listed`` marks items from entries that are themselves lists of messages.
    ``enveloped`` opens attribute-value envelopes at every level of the map.
    ``members`` stand for the value of a map that was cut into them.
    """
    return bind(map_members(value, members), lambda entries: _map_items(entries, enveloped))


def map_members(value: Column, members: Column | None = None) -> Column:
    """Members of a message map, whether it was read whole or cut."""
    whole = F.map_entries(as_map(value))
    return whole if members is None else F.coalesce(members, whole)


def is_tagged_map(value: Column) -> Column:
    """Is a member of a message map an envelope?"""
    return field(value, "M").isNotNull() | field(value, "L").isNotNull()


def _map_items(entries: Column, enveloped: bool) -> Column:
    opened = _open if enveloped else lambda v: v
    if enveloped:
        entries = F.transform(entries, lambda e: F.struct(e["key"].alias("key"), _open(e["value"]).alias("value")))

    def member(value: Column, name: str) -> Column:
        return opened(field(value, name))

    def role(entry: Column) -> Column:
        # A missing role is named by the entry's key; a null role is no role.
        named = field(entry["value"], "role")
        return F.when(named.isNull(), entry["key"]).otherwise(F.try_variant_get(opened(named), "$", "string"))

    def item(message_id: Column, role: Column, body: Column, listed: bool) -> Column:
        text = F.when(is_string(body), F.try_variant_get(body, "$", "string"))
        return F.struct(
            message_id.alias("message_id"), role.alias("role"), text.alias("body"), F.lit(listed).alias("listed")
        )

    def contents(entry: Column) -> Column:
        def items(content: Column) -> Column:
            bodies = F.coalesce(
                F.transform(as_list(content), lambda c: member(opened(c), "body")),
                F.filter(F.array(content), lambda c: c.isNotNull()),
            )
            return F.transform(bodies, lambda body: item(entry["key"], role(entry), body, False))

        return bind(member(entry["value"], "content"), items)

    def listed(entry: Column) -> Column:
        messages = F.transform(F.coalesce(as_list(entry["value"]), _no_variants()), opened)
        return F.transform(messages, lambda m: item(
            entry["key"], F.coalesce(F.try_variant_get(member(m, "role"), "$", "string"), F.lit("")),
            F.coalesce(member(m, "content"), member(m, "body")), True,
        ))

    return bind(entries, lambda e: F.concat(F.flatten(F.transform(e, contents)), F.flatten(F.transform(e, listed))))


def _no_variants() -> Column:
    return F.array().cast("array<variant>")


def map_tokens(value: Column, enveloped: bool = False) -> Column:
    """Message map -> ``struct<input_token, output_token>``.

    List entries count only when the map has none of the usual keys, or when
    its other entries gave no token. Nothing found counts as one and one, and an
    empty value as none at all. A bare text is input.
    """

    text = F.when(is_string(value), F.try_variant_get(value, "$", "string"))
    other = (
        F.when(value.isNull() | F.is_variant_null(value), _pair(F.lit(0), F.lit(0)))
        .when(F.to_json(value).isin("[]", '""', "0", "false"), _pair(F.lit(0), F.lit(0)))
        .when(text.isNotNull(), _pair(chars4_tokens(text), F.lit(0)))
        .otherwise(_pair(F.lit(1), F.lit(1)))
    )
    return F.coalesce(bind(F.map_entries(as_map(value)), lambda e: member_tokens(e, enveloped)), other)


def member_tokens(entries: Column, enveloped: bool = False) -> Column:
    """Members of a message map, ``array<struct<key, value>>`` -> ``struct<input_token, output_token>``."""
    usual_key = F.exists(entries, lambda e: e["key"].isin(*V.MAP_KEYS))
    found = bind(_map_items(entries, enveloped), lambda items: _item_tokens(items, usual_key))
    empty = F.size(entries) == 0
    return F.when(empty, _pair(F.lit(0), F.lit(0))).when(entries.isNotNull(), found)


def _pair(input_token: Column, output_token: Column) -> Column:
    return F.struct(
        input_token.cast("int").alias("input_token"), output_token.cast("int").alias("output_token")
    )


def _item_tokens(entries: Column, usual_key: Column) -> Column:
    counted = F.transform(entries, lambda e: F.struct(
        e["listed"].alias("listed"),
        F.when(e["role"].isin(*V.INPUT_ROLES), "in").when(e["role"].isin(*V.OUTPUT_ROLES), "out").alias("side"),
        chars4_tokens(e["body"]).alias("n"),
    ))

    def totals(items: Column) -> Column:
        def total(side: str, listed: bool) -> Column:
            return F.aggregate(items, F.lit(0), lambda n, e: n + F.when(
                (e["side"] == side) & (e["listed"] == F.lit(listed)), e["n"]
            ).otherwise(F.lit(0)))

        return F.struct(
            total("in", False).alias("main_in"), total("out", False).alias("main_out"),
            total("in", True).alias("list_in"), total("out", True).alias("list_out"),
        )

    def choose(t: Column) -> Column:
        use_lists = ~usual_key | ((t["main_in"] == 0) & (t["main_out"] == 0))
        return _pair(
            t["main_in"] + F.when(use_lists, t["list_in"]).otherwise(F.lit(0)),
            t["main_out"] + F.when(use_lists, t["list_out"]).otherwise(F.lit(0)),
        )

    def at_least_one(found: Column) -> Column:
        nothing = (found["input_token"] == 0) & (found["output_token"] == 0)
        return F.when(nothing, _pair(F.lit(1), F.lit(1))).otherwise(found)

    return bind(bind(bind(counted, totals), choose), at_least_one)
