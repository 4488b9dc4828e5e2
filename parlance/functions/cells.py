"""Lists and objects of any size: their elements are cut out of the text and read one by one.

A VARIANT holds at most 128 MiB, so the text of a larger list or object cannot
be read as one value. One linear scan over the text cuts it at its top level;
strings are walked over, and brackets may be nested up to a fixed depth inside
an element. Each element is then read alone. Texts up to ``WHOLE_BYTES`` are
read whole, which gives the same elements; the bound leaves room for values that
take more bytes than their text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from parlance.functions.grammar import STRING
from parlance.functions.literal import as_list, read_json, read_value
from parlance.functions.text import bind, strip

WHOLE_BYTES = 16 << 20
DEPTH = 12  # levels of brackets inside an element

_PLAIN = r"""[^"'{}\[\]()]++"""


def _nested(depth: int) -> str:
    inner = f"|{_nested(depth - 1)}" if depth > 1 else ""
    return rf"[\[{{(](?:{_PLAIN}|{STRING}{inner})*+[\]}})]"


_ELEMENT = rf"""(?:[^"'{{}}\[\](),]++|{STRING}|{_nested(DEPTH)})++"""
_VALUE = rf"""(?:[^"'{{}}\[\](),:]++|{STRING}|{_nested(DEPTH)})++"""
_LIST_ITEM = rf"\G({_ELEMENT})(?:,|\z)"
_MEMBER = rf"\G\s*+({STRING})\s*+:({_VALUE})(?:,|\z)"


def _pieces(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _inside(text: Column) -> Column:
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _all_of(text: Column, pattern: str, use: Callable[[Column], Column]) -> Column:
    """``use`` of the text, if matches of the pattern, one after the other, are all of it."""
    matched = F.aggregate(_pieces(text, pattern, 0), F.lit(0), lambda n, p: n + F.octet_length(p))
    return F.when(matched == F.octet_length(text), use(text))


def split_list(text: Column) -> Column:
    """Text of a list -> the texts of its elements; null if it cannot be cut.

    Blanks around the list are not expected. Blank text after the last comma is
    no element.
    """

    def cut(inner: Column) -> Column:
        items = F.transform(_pieces(inner, _LIST_ITEM, 1), strip)
        last_blank = F.get(items, F.size(items) - 1) == ""
        return F.when(last_blank, F.slice(items, F.lit(1), F.size(items) - 1)).otherwise(items)

    listed = F.startswith(text, F.lit("[")) & F.endswith(text, F.lit("]"))
    return F.when(listed, bind(_inside(text), lambda inner: _all_of(inner, _LIST_ITEM, cut)))


def split_members(text: Column) -> Column:
    """Text of an object -> ``array<struct<key, value>>`` of texts; null if it cannot be cut."""

    def cut(inner: Column) -> Column:
        keys, values = _pieces(inner, _MEMBER, 1), _pieces(inner, _MEMBER, 2)
        return F.zip_with(keys, values, lambda k, v: F.struct(k.alias("key"), strip(v).alias("value")))

    # Blank text after the last member's comma matches nothing.
    body = F.regexp_replace(_inside(text), r",?\s*+\z", "")
    is_object = F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}"))
    return F.when(is_object, bind(body, lambda inner: F.when(
        inner == "", F.array().cast("array<struct<key: string, value: string>>")
    ).otherwise(_all_of(inner, _MEMBER, cut))))


def _small(text: Column, whole_bytes: int) -> Column:
    return F.octet_length(text) <= whole_bytes


def read_parts(text: Column, parts: Column, read: Callable[[Column], Column], of_whole: Callable[[Column], Column]) -> Column:
    """``of_whole`` of the text's value, or, where ``parts`` are its elements, their values; null if one cannot be read.

    The reader, a long expression, occurs once.
    """
    values = F.transform(F.coalesce(parts, F.array(text)), read)
    return bind(values, lambda found: F.when(parts.isNull(), of_whole(F.get(found, F.lit(0)))).when(
        F.forall(found, lambda v: v.isNotNull()), found))


def read_list(text: Column, read: Callable[[Column], Column] = read_value, whole_bytes: int = WHOLE_BYTES) -> Column:
    """Text of a list of any size -> array of VARIANT; null when it is no list that can be read."""
    parts = F.when(~_small(text, whole_bytes), split_list(text))
    return bind(parts, lambda found: F.when(
        _small(text, whole_bytes) | found.isNotNull(), read_parts(text, found, read, as_list)))


def read_members(text: Column, whole_bytes: int = WHOLE_BYTES) -> Column:
    """JSON text of an object beyond ``whole_bytes`` -> ``array<struct<key, value variant>>``, else null.

    Of repeated keys the last counts. The only member of a tagged map is its map,
    which is cut in its place.
    """

    def read(member: Column) -> Column:
        key = F.try_variant_get(read_json(member["key"]), "$", "string")
        return F.struct(key.alias("key"), read_json(member["value"]).alias("value"))

    def last_of_each(entries: Column) -> Column:
        places = F.array_sort(F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"))))

        def kept(order: Column) -> Column:
            last = F.filter(order, lambda p, k: ~F.coalesce(F.get(order, k + 1)["key"] == p["key"], F.lit(False)))
            at = F.array_sort(F.transform(last, lambda p: p["i"]))
            return F.transform(at, lambda i: F.get(entries, i))

        return bind(places, kept)

    def all_read(entries: Column) -> Column:
        good = F.forall(entries, lambda e: e["key"].isNotNull() & e["value"].isNotNull())
        return F.when(good, last_of_each(entries))

    def content(members: Column) -> Column:
        tagged = (F.size(members) == 1) & (F.get(members, F.lit(0))["key"] == '"M"')
        return F.when(tagged, F.coalesce(split_members(F.get(members, F.lit(0))["value"]), members)).otherwise(members)

    members = F.transform(bind(split_members(text), content), read)
    return F.when(~_small(text, whole_bytes), bind(members, all_read))
