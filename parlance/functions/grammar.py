"""Python literals as JSON text, by one scan that cuts them into tokens.

Every token gets a kind of one character, so the kinds of a text are a short
string in which structure is found by patterns: what is a set, a tuple, a value
in parentheses, a key, a comma after the last element. The tokens are then
written as JSON, each by its kind. Whether the result is well formed is decided
by the JSON reader, so texts that are no literals come out as null there.

Read as in Python: strings in one or three quotes of either sort, with the
prefixes r, u and b, their escapes, strings that follow each other; integers of
all bases, reals, underscores, signs; None, True, False; lists, tuples, sets,
dictionaries, comments. Sets are lists in written order, bytes are the text of
their Latin-1 characters, and keys that are no strings are the text of their
JSON form. Not read: characters by name, complex numbers, integers of other
bases beyond 60 bits, single surrogates, parentheses around a nested container.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parlance.functions.text import bind

_PREFIX = r"(?:[bB][rR]|[rR][bB]|[rRuUbB])?"
_TRIPLE = r"'''(?:[^'\\]++|\\[\s\S]|'(?!''))*+'''" + r'|"""(?:[^"\\]++|\\[\s\S]|"(?!""))*+"""'
_SINGLE = r"'(?:[^'\\\n\r]++|\\[\s\S])*+'" + r'|"(?:[^"\\\n\r]++|\\[\s\S])*+"'
STRING = rf"{_PREFIX}(?:{_TRIPLE}|{_SINGLE})"
_DIGITS = r"\d(?:_?\d)*+"
_NUMBER = (
    r"(?:[-+]\s*+)?(?:0[xX](?:_?[0-9a-fA-F])++|0[oO](?:_?[0-7])++|0[bB](?:_?[01])++"
    rf"|(?:{_DIGITS}\.(?:{_DIGITS})?+|\.{_DIGITS}|{_DIGITS})(?:[eE][-+]?{_DIGITS})?+)(?![\w.])"
)
_TOKEN = rf"{STRING}(?:\s*+{STRING})*+|{_NUMBER}|[^\W\d]\w*+|#[^\n]*+|[\[\]{{}}(),:]|\S"

_WORDS = {"None": "null", "True": "true", "False": "false", "null": "null", "true": "true", "false": "false"}
_VALUE_END = r"snwk\]})"

# Structure, found on the kinds: s string, n number, w word, k key, a blank for nothing, x for what is no literal.
_STRUCTURE = (
    # A set holds no brackets, braces or colons.
    (r"\{([^{}\[\]:]++)\}", "[$1]"),
    # One value in parentheses is that value; twice, for parentheses in parentheses.
    (r"\(([snw]|\[[^\[\]{}()]*+\]|\{[^\[\]{}()]*+\})\)", " $1 "),
    (r"\( ([snw]|\[[^\[\]{}()]*+\]|\{[^\[\]{}()]*+\}) \)", "  $1  "),
    (r"[nw](?= *+:)", "k"),
    (rf"(?<=[{_VALUE_END} ]),(?= *+[\]}})])", " "),
    (r"\(", "["),
    (r"\)", "]"),
)

_ESCAPED = {
    "\\\\": "\\", "\\'": "'", '\\"': '"', "\\n": "\n", "\\r": "\r", "\\t": "\t", "\\b": "\b", "\\f": "\f",
    "\\a": "\x07", "\\v": "\x0b", "\\\n": "",
}
_UNITS = r"(?:\\u[0-9a-fA-F]{4})++"
_PART = rf"[^\\]++|{_UNITS}|\\x[0-9a-fA-F]{{2}}|\\U[0-9a-fA-F]{{8}}|\\[0-7]{{1,3}}|\\[\s\S]"
_WHOLE_UNITS = r"^(?:\\u(?![dD][89a-fA-F])[0-9a-fA-F]{4}|\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2})++$"
_CODE_POINT = r"^\\U(?:0000(?![dD][89a-fA-F])[0-9a-fA-F]|000[1-9a-fA-F]|0010)"


def _table(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(text) for pair in values.items() for text in pair])


def _utf16(digits: Column) -> Column:
    return F.decode(F.unhex(digits), "UTF-16BE")


def _decoded(part: Column, is_bytes: Column) -> Column:
    """One part of a string's body -> its characters; null for what is not read."""
    simple = F.coalesce(F.try_element_at(_table(_ESCAPED), part), part)
    second = F.substring(part, 2, 1)
    rest = F.substring(part, F.lit(3), F.length(part))
    octal = F.lpad(F.conv(F.substring(part, F.lit(2), F.length(part)), 8, 16), 4, "0")
    return (
        F.when(~F.startswith(part, F.lit("\\")), part)
        .when((second == "x") & (F.length(part) == 4), _utf16(F.concat(F.lit("00"), rest)))
        .when(part.rlike(r"^\\[0-7]"), _utf16(octal))
        .when(is_bytes, simple)
        .when(part.rlike(_WHOLE_UNITS), _utf16(F.replace(part, F.lit("\\u"), F.lit(""))))
        .when(part.rlike(_CODE_POINT), F.decode(F.unhex(rest), "UTF-32"))
        .when(second.isin("x", "u", "U", "N"), F.lit(None).cast("string"))
        .otherwise(simple)
    )


def _string_value(written: Column) -> Column:
    """One string as written, with its prefix and quotes -> its characters; null for what is not read."""
    prefix = F.lower(F.regexp_extract(written, "^[a-zA-Z]*+", 0))
    quoted = F.substring(written, F.length(prefix) + 1, F.length(written))
    triple = (F.length(quoted) >= 6) & (F.startswith(quoted, F.lit("'''")) | F.startswith(quoted, F.lit('"""')))
    width = F.when(triple, F.lit(3)).otherwise(F.lit(1))
    body = F.substring(quoted, width + 1, F.length(quoted) - 2 * width)
    plain = F.contains(prefix, F.lit("r")) | ~F.contains(body, F.lit("\\"))

    def escaped(text: Column) -> Column:
        parts = F.transform(F.regexp_extract_all(text, F.lit(_PART), F.lit(0)),
                            lambda p: _decoded(p, F.contains(prefix, F.lit("b"))))
        return bind(parts, lambda p: F.when(~F.exists(p, lambda x: x.isNull()), F.array_join(p, "")))

    return F.when(plain, body).otherwise(escaped(body))


def _string(token: Column) -> Column:
    """Strings that follow each other -> one JSON string."""
    values = F.transform(F.regexp_extract_all(token, F.lit(STRING), F.lit(0)), _string_value)

    def joined(found: Column) -> Column:
        listed = F.to_json(F.array(F.array_join(found, "")))
        return F.when(~F.exists(found, lambda v: v.isNull()), F.substring(listed, F.lit(2), F.length(listed) - 2))

    return bind(values, joined)


def _number(token: Column) -> Column:
    """A number as JSON writes it."""

    def written(t: Column) -> Column:
        sign = F.when(F.startswith(t, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
        digits = F.lower(F.ltrim(t, F.lit("-")))
        real = F.regexp_replace(F.regexp_replace(digits, r"^\.", "0."), r"\.(?=$|e)", ".0")

        def based(mark: str, base: int, places: int) -> Column:
            return F.when(F.length(digits) <= places + 2, F.conv(F.substring(digits, F.lit(3), F.length(digits)), base, 10))

        return F.concat(
            sign,
            F.when(F.startswith(digits, F.lit("0x")), based("0x", 16, 15))
            .when(F.startswith(digits, F.lit("0o")), based("0o", 8, 20))
            .when(F.startswith(digits, F.lit("0b")), based("0b", 2, 60))
            .otherwise(real),
        )

    return bind(F.regexp_replace(token, r"[\s_+]", ""), written)


def _word(token: Column) -> Column:
    return F.try_element_at(_table(_WORDS), token)


def _kind(token: Column) -> Column:
    return (
        F.when(token.rlike(rf"""^{_PREFIX}["'][\s\S]"""), F.lit("s"))
        .when(token.rlike(r"^[-+]?\s*+\.?\d"), F.lit("n"))
        .when(F.length(token) == 1, F.when(token.rlike(r"[\[\]{}(),:]"), token).otherwise(F.lit("x")))
        .when(token.isin(*_WORDS), F.lit("w"))
        .otherwise(F.lit("x"))
    )


def _structured(kinds: Column) -> Column:
    for pattern, replacement in _STRUCTURE:
        kinds = F.regexp_replace(kinds, pattern, replacement)
    return kinds


def _written(token: Column, kind: Column) -> Column:
    quote = F.when(kind == "k", F.lit('"')).otherwise(F.lit(""))
    value = (
        F.when(kind == "s", _string(token))
        .when(kind.isin("n", "w", "k"), F.concat(quote, F.coalesce(_word(token), _number(token)), quote))
        .when(kind != "x", kind)
    )
    return F.coalesce(value, F.lit("?"))


def json_of_literal(text: Column) -> Column:
    """Text of a Python literal -> JSON text. What is no literal comes out as no JSON."""
    tokens = F.filter(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), lambda t: ~F.startswith(t, F.lit("#")))

    def written(found: Column) -> Column:
        kinds = _structured(F.array_join(F.transform(found, _kind), ""))
        return F.array_join(F.zip_with(found, F.split(kinds, ""), lambda t, k: F.when(t.isNotNull(), _written(t, k))), " ")

    return bind(tokens, written)
