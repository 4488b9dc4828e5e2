"""Attribute-value envelopes: ``{"S": "x"}``, ``{"L": [{"M": {...}}]}`` and so on.

The unwrapped shape of a value is described by a Spark type. The expressions
are generated from that type, so a plan reads only the fields it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from parlance.functions.literal import as_list, as_map, field, field_text, read_json
from parlance.functions.text import bind, strip

_SETS = ("SS", "BS", "NS")
# Levels of brackets that are followed; the store itself nests attributes at most 32 deep, two brackets each.
DEPTH = 64
_TEXT = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_WHOLE, _REAL = r"-?(?:0|[1-9]\d*+)", r"-?(?:0|[1-9]\d*+)\.\d++(?:[eE][+-]?\d++)?"


def _balanced(depth: int) -> str:
    inner = f"|{_balanced(depth - 1)}" if depth > 1 else ""
    return rf"""[{{\[](?:[^{{}}\[\]"]++|{_TEXT}{inner})*+[}}\]]"""


# JSON as Spark writes it holds no blanks outside strings and no control character, so this one marks
# the brackets that are done. A quote inside a string is escaped, so a brace and a quoted tag are never part of one.
_DONE = "\x01"
_SKIPPED = rf"""[^{{\["]++|{_TEXT}|(?<={_DONE})[{{\[]"""
_BALANCED = _balanced(DEPTH)
_OPEN = (
    rf"""(?s)\G((?:{_SKIPPED})*+)(?:\{{(?:"S":({_TEXT})|"N":"?({_REAL}|{_WHOLE})"?|"N":({_TEXT})|"BOOL":(true|false)"""
    rf"""|"NULL":(null)|"M":(?=\{{)({_BALANCED})|"(?:L|SS|BS)":(?=\[)({_BALANCED})|"(NS)":(?=\[)({_BALANCED}))\}}"""
    rf"""|({_BALANCED}))"""
)
_HAS_OPEN = rf"""(?s)^(?:{_SKIPPED})*+[{{\[]"""
# A number set keeps its tag until its elements are written as numbers.
_OPENED = f"$1$9{_DONE}$2$3$4$5$6$7$8$10$11"
_NUMBER_SET = f"NS{_DONE}["
_NUMBERS = rf"""(?s)(NS{_DONE}\[|\G,)(?:"({_REAL}|{_WHOLE})"|({_TEXT}))"""
# For text that is tagged throughout, at any depth.
_PLAIN_FORMS = (
    (rf"""(?s)\{{\s*+"S"\s*+:\s*+({_TEXT})\s*+\}}""", "$1"),
    (rf"""\{{\s*+"N"\s*+:\s*+"?({_REAL}|{_WHOLE})"?\s*+\}}""", "$1"),
    (rf"""(?s)\{{\s*+"N"\s*+:\s*+({_TEXT})\s*+\}}""", "$1"),
    (r"""\{\s*+"BOOL"\s*+:\s*+(true|false)\s*+\}""", "$1"),
    (r"""\{\s*+"NULL"\s*+:\s*+(?:true|false)\s*+\}""", "null"),
    (r"""\{\s*+"(?:L|SS|NS|BS)"\s*+:\s*+\[""", "["),
    (r"""\{\s*+"M"\s*+:\s*+\{""", "{"),
    # What is left closes a list or an object, and then its tag.
    (rf"""(?s)\G((?:[^"\]}}]++|{_TEXT}|[\]}}](?!\s*+\}}))*+)([\]}}])\s*+\}}""", "$1$2"),
)


def unwrap(value: Column, target: T.DataType) -> Column:
    """Unwrap an enveloped VARIANT into a column of type ``target``.

    A value without a tag is read as it is, so partly unwrapped data works.
    """
    if isinstance(target, T.StructType):
        members = F.coalesce(field(value, "M"), value)
        fields = [unwrap(field(members, f.name), f.dataType).alias(f.name) for f in target.fields]
        return F.when(as_map(members).isNotNull(), F.struct(*fields))
    if isinstance(target, T.MapType):
        members = F.coalesce(field(value, "M"), value)
        return F.transform_values(as_map(members), lambda _, v: unwrap(v, target.valueType))
    if isinstance(target, T.ArrayType):
        # List items carry their own envelope; set items are plain.
        items = F.coalesce(as_list(field(value, "L")), *[as_list(field(value, s)) for s in _SETS], as_list(value))
        return F.transform(items, lambda v: unwrap(v, target.elementType))
    if isinstance(target, T.VariantType):
        return unwrap_any(value)
    return unwrap_text(value).try_cast(target)


def unwrap_text(value: Column) -> Column:
    """Scalar envelope -> text; NULL gives null, anything untagged its own text."""
    return F.coalesce(
        field_text(value, "S"),
        field_text(value, "N"),
        field_text(value, "BOOL"),
        F.when(field(value, "NULL").isNull(), F.try_variant_get(value, "$", "string")),
    )


def unwrap_scalar(value: Column) -> Column:
    """Scalar envelope -> VARIANT of the natural type (text, integer, real, boolean)."""
    return (
        F.when(field(value, "S").isNotNull(), field(value, "S"))
        .when(field(value, "N").isNotNull(), tagged_number(field_text(value, "N")))
        .when(field(value, "BOOL").isNotNull(), field(value, "BOOL"))
        .when(field(value, "NULL").isNotNull(), F.lit(None).cast("variant"))
        .otherwise(value)
    )


def plain_json(text: Column) -> Column:
    """JSON text of enveloped values -> the same without tags, however tagged and untagged values hold each other.

    Each pass opens the outermost values that are not open yet and marks their
    brackets as done, so an object that was below a tag keeps a key that has the
    name of a tag. There are as many passes as the text has levels. Text with more
    levels than are followed has to be tagged throughout.
    """
    nulls = F.regexp_replace(text, r"""\{"NULL":(?:true|false)\}""", '{"NULL":null}')
    passes = F.sequence(F.lit(1), F.least(F.lit(DEPTH), F.regexp_count(text, F.lit(r"[{\[]")) + 1))

    def opened_once(state: Column, _: Column) -> Column:
        # A pass that changes nothing is the last one; a text has more brackets than levels.
        return F.when(state["more"], bind(F.regexp_replace(state["t"], _OPEN, _OPENED), lambda t: F.struct(
            t.alias("t"), (t != state["t"]).alias("more")))).otherwise(state)

    opened = F.aggregate(
        passes, F.struct(nulls.alias("t"), F.lit(True).alias("more")), opened_once, lambda state: state["t"])

    def closed(t: Column) -> Column:
        numbers = F.when(F.contains(t, F.lit(_NUMBER_SET)), F.replace(
            F.regexp_replace(t, _NUMBERS, "$1$2$3"), F.lit(_NUMBER_SET), F.lit("["))).otherwise(t)
        return F.replace(numbers, F.lit(_DONE), F.lit(""))

    return bind(opened, lambda t: F.when(t.rlike(_HAS_OPEN), _tagged_throughout(text)).otherwise(closed(t)))


def _tagged_throughout(text: Column) -> Column:
    for pattern, replacement in _PLAIN_FORMS:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def unwrap_any(value: Column) -> Column:
    """Enveloped VARIANT of unknown shape -> VARIANT without tags at any depth."""

    def opened(v: Column) -> Column:
        return F.when(_is_scalar(v), unwrap_scalar(v)).otherwise(bind(F.to_json(v), lambda text: F.when(
            F.left(text, F.lit(1)).isin("{", "["), F.coalesce(read_json(plain_json(text)), v)).otherwise(v)))

    return bind(value, opened)


def _is_scalar(value: Column) -> Column:
    found = field(value, "S").isNotNull()
    for tag in ("N", "BOOL", "NULL"):
        found = found | field(value, tag).isNotNull()
    return found


def tagged_number(text: Column) -> Column:
    """Text of a number tag -> VARIANT: real with a dot, else integer, else the text."""
    real = F.when(F.contains(text, F.lit(".")), text.try_cast("double"))
    whole = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("decimal(38,0)"))
    return F.coalesce(real.cast("variant"), whole.cast("variant"), text.cast("variant"))


def open_scalar(cell: Column) -> Column:
    """Cell text -> the text inside a scalar envelope; any other cell stays as it is."""
    text = strip(cell)
    value = F.when(F.startswith(text, F.lit("{")), read_json(text))

    def opened(v: Column) -> Column:
        tagged = field(v, "S").isNotNull() | field(v, "N").isNotNull() | field(v, "NULL").isNotNull()
        return F.when(tagged, unwrap_text(v)).otherwise(cell)

    return bind(value, opened)


def collapse_list(items: Column, list_mode: str = "all") -> Column:
    """``first`` keeps the first element of a list (null when empty); ``all`` keeps it whole."""
    if list_mode not in ("first", "all"):
        raise ValueError(f"list_mode must be 'first' or 'all', not {list_mode!r}")
    return F.get(items, F.lit(0)) if list_mode == "first" else items
