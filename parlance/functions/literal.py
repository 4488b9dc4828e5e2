"""Reading JSON text and Python-literal text into VARIANT values.

Both readers give null for text they cannot read, so they never fail a job.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parlance.functions.grammar import json_of_literal
from parlance.functions.text import bind

_DOUBLE = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_SINGLE = r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
_LITERAL_OPTIONS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
_BARE_WORDS = {"None": "null", "True": "true", "False": "false"}


def _outside_strings(word: str) -> str:
    # Walks over whole quoted strings, so a word inside one is never touched.
    # All loops are possessive: linear time and constant stack on long texts.
    first, rest = word[0], word[1:]
    return rf"""(?s)\G((?:[^"'{first}]++|{_DOUBLE}|{_SINGLE}|{first}(?!{rest}\b))*+){word}\b"""


# Escapes that mean the same in JSON, and byte escapes, which are rewritten.
_COMMON_ESCAPES = r"""^(?:[^\\]++|\\(?:[\\'"nrtbf]|u[0-9a-fA-F]{4}|x[0-9a-fA-F]{2}))*+$"""


def literal_to_json(text: Column) -> Column:
    """A literal as ``repr`` writes it -> JSON text but for single quotes; null if it has other escapes.

    Bare words and byte escapes are rewritten. Nothing else inside a string changes.
    """
    rewrites = [
        (lambda t, word=word: F.contains(t, F.lit(word)), _outside_strings(word), "$1" + json_word)
        for word, json_word in _BARE_WORDS.items()
    ]
    rewrites.append((
        lambda t: F.contains(t, F.lit("\\x")), r"(?<!\\)((?:\\\\)*+)\\x([0-9a-fA-F]{2})", r"$1\\u00$2"))
    out = F.when(~F.contains(text, F.lit("\\")) | text.rlike(_COMMON_ESCAPES), text)
    for needed, pattern, replacement in rewrites:
        out = bind(out, _rewrite_if(needed, pattern, replacement))
    return out


def _rewrite_if(needed, pattern: str, replacement: str):
    # The cheap test spares most texts the walk over their strings.
    return lambda t: F.when(needed(t), F.regexp_replace(t, pattern, replacement)).otherwise(t)


def _only_element(wrapped: Column) -> Column:
    # The readers ignore what follows the first value. Reading the text as the
    # only element of a list makes trailing text an error instead.
    return bind(wrapped, lambda w: F.when(
        F.try_variant_get(w, "$[1]", "variant").isNull(), F.try_variant_get(w, "$[0]", "variant")
    ))


def _bracketed(text: Column) -> Column:
    return F.concat(F.lit("["), text, F.lit("]"))


def read_json(text: Column) -> Column:
    """JSON text -> VARIANT."""

    def read(t: Column) -> Column:
        # A single quote right after the brackets cannot be JSON. Not trying it
        # saves the costly failure on data written as literals.
        quoted = F.left(t, F.lit(8)).rlike(r"^[\[{\s]*+'")
        return F.when(~quoted, _only_element(F.try_parse_json(_bracketed(t))))

    return bind(text, read)


def _last_of_each(entries: Column) -> Column:
    """Entries -> VARIANT object; the last value of a repeated key counts. The keys are sorted once."""
    places = F.sort_array(F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"))))

    def kept(order: Column) -> Column:
        last = F.filter(order, lambda p, k: ~F.coalesce(F.get(order, k + 1)["key"] == p["key"], F.lit(False)))
        at = F.sort_array(F.transform(last, lambda p: p["i"]))
        return F.to_variant_object(F.map_from_entries(F.transform(at, lambda i: F.get(entries, i))))

    return bind(places, kept)


def read_json_object(text: Column) -> Column:
    """JSON text of an object, or of a list of objects, with repeated keys -> VARIANT; the last value of a key counts."""
    listed = F.startswith(F.ltrim(text), F.lit("["))
    maps = F.from_json(F.when(listed, text).otherwise(_bracketed(text)), "array<map<string,variant>>")
    objects = F.transform(maps, lambda m: F.when(m.isNotNull(), _last_of_each(F.map_entries(m))))

    def read(found: Column) -> Column:
        good = F.forall(found, lambda v: v.isNotNull())
        return F.when(listed & good, F.to_variant_object(found)).when(good & (F.size(found) == 1), F.get(found, F.lit(0)))

    return bind(objects, read)


def read_literal(text: Column) -> Column:
    """Python-literal text -> VARIANT.

    Text as ``repr`` writes it is almost JSON and takes the short way; any other
    literal is cut into tokens.
    """

    def short(t: Column) -> Column:
        return _only_element(F.from_json(_bracketed(t), "variant", _LITERAL_OPTIONS))

    def long(t: Column) -> Column:
        return F.coalesce(_only_element(F.try_parse_json(_bracketed(t))), read_json_object(t))

    return bind(text, lambda t: F.coalesce(bind(literal_to_json(t), short), bind(json_of_literal(t), long)))


def read_value(text: Column) -> Column:
    """JSON text, or else Python-literal text -> VARIANT."""
    return F.coalesce(read_json(text), read_literal(text))


def as_list(value: Column) -> Column:
    """VARIANT -> array of VARIANT, null when it is not a list."""
    return value.try_cast("array<variant>")


def as_map(value: Column) -> Column:
    """VARIANT -> map of VARIANT, null when it is not an object."""
    return value.try_cast("map<string,variant>")


def is_string(value: Column) -> Column:
    """Does a VARIANT hold a string?"""
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def field(value: Column, *names: str) -> Column:
    """Nested field of a VARIANT, null when absent."""
    return F.try_variant_get(value, _path(names), "variant")


def field_text(value: Column, *names: str) -> Column:
    """Nested field of a VARIANT as text, null when absent or null."""
    return F.try_variant_get(value, _path(names), "string")


def _path(names: tuple[str, ...]) -> str:
    return "$" + "".join(f"['{name}']" for name in names)
