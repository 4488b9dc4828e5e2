"""Questions a user asked, read from a transcript."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from parlance import fixed_values as V
from parlance.functions.text import bind, split_on, strip

_MIN_BOT_TEXT = 10
_S = f"[{V.WHITESPACE_CLASS}]"
_INLINE_QUESTION = V.INLINE_QUESTION.replace("{S}", _S)


def _after_prefix(text: Column, prefix: str) -> Column:
    return strip(F.substring(text, F.lit(len(prefix) + 1), F.length(text)))


def _starts_with(text: Column, prefix: str) -> Column:
    return F.lower(F.left(text, F.lit(len(prefix)))) == prefix


def _segment_questions(segments: Column) -> Column:
    # Only the user's segments are trimmed at both ends; the prefix needs the left end alone.
    from_start = F.transform(segments, lambda s: F.ltrim(s, F.lit(V.WHITESPACE)))
    spoken = F.filter(from_start, lambda s: _starts_with(s, "user:"))
    return F.filter(F.transform(spoken, lambda s: _after_prefix(s, "user:")), lambda q: q != "")


def dialogue_questions(dialogue: Column) -> Column:
    """Distinct user questions of one dialogue, in order."""
    return F.array_distinct(_segment_questions(split_on(dialogue, V.PART_SEPARATOR)))


def _dialect(pattern: str) -> str:
    # The Unicode classes are slow, so only patterns with \w or \s ask for them.
    return f"(?U){pattern}" if "\\" in pattern else pattern


def _stems(pattern: str) -> list[str]:
    """Plain texts of which a match of the pattern holds at least one; empty if there are none."""
    wrapped = pattern.startswith("(?:") and pattern.endswith(")")
    stems = []
    for form in pattern[3:-1].split("|") if wrapped else [pattern]:
        stem = re.match(r"[\w ]*", form)[0]
        stems.append(stem[:-1] if form[len(stem):len(stem) + 1] in ("?", "*", "{") and stem else stem)
    return stems if all(stems) else []


def _found(text: Column, pattern: str) -> Column:
    """Does the pattern occur? Its plain beginnings are searched first, which is much faster and mostly enough."""
    stems = _stems(pattern)
    plain = reduce(or_, [F.contains(text, F.lit(stem)) for stem in stems]) if stems else F.lit(True)
    words = pattern[3:-1] if pattern.startswith("(?:") and pattern.endswith(")") else pattern
    return plain if re.fullmatch(r"[\w |]+", words) else plain & text.rlike(_dialect(pattern))


def implied_question(bot_text: Column, rules=V.IMPLIED_QUESTIONS, fill_topic: bool = False) -> Column:
    """Question implied by a bot answer: the first rule that matches, else ``''``.

    The topic captured by a rule is left out of the question unless
    ``fill_topic`` asks for it.
    """
    lowered = F.lower(bot_text)
    out = F.when(F.coalesce(F.length(strip(bot_text)) < _MIN_BOT_TEXT, F.lit(True)), F.lit(""))
    for pattern, question in rules:
        before, slot, after = question.partition("{}")
        topic = strip(F.regexp_extract(lowered, _dialect(pattern), 1)) if slot and fill_topic else F.lit("")
        out = out.when(_found(lowered, pattern), F.concat(F.lit(before), topic, F.lit(after)))
    return out.otherwise(F.lit(""))


def user_questions(transcript: Column, rules=V.IMPLIED_QUESTIONS) -> Column:
    """Distinct user questions of a transcript, joined in order.

    Several dialogues, one dialogue, a single user or bot message and free text
    are read in different ways; the first form that fits decides.
    """
    return bind(strip(transcript), lambda text: _questions_of(text, rules))


def _questions_of(text: Column, rules) -> Column:
    dialogues = F.transform(split_on(text, V.CONVERSATION_SEPARATOR), strip)
    across = F.flatten(
        F.transform(dialogues, lambda d: _segment_questions(split_on(d, V.PART_SEPARATOR)))
    )
    alone = _after_prefix(text, "user:")
    implied = implied_question(text, rules)
    inline = F.filter(
        F.transform(F.regexp_extract_all(text, F.lit(_INLINE_QUESTION), F.lit(1)), strip), lambda q: q != ""
    )

    def joined(questions: Column) -> Column:
        return F.array_join(F.array_distinct(questions), V.PART_SEPARATOR)

    return (
        F.when(F.coalesce(text, F.lit("")).isin("", *V.BLANK_WORDS_EXACT), F.lit(""))
        .when(F.contains(text, F.lit(V.CONVERSATION_SEPARATOR)), joined(across))
        .when(F.contains(text, F.lit(V.PART_SEPARATOR)), joined(_segment_questions(split_on(text, V.PART_SEPARATOR))))
        .when(_starts_with(text, "user:"), alone)
        .when(_starts_with(text, "bot:"), implied)
        .otherwise(joined(inline))
    )
