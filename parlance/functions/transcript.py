"""Transcripts: ``user: ... | bot: ...`` and the texts inside them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parlance import fixed_values as V
from parlance.functions.cells import WHOLE_BYTES, read_list, read_parts, split_list, split_members
from parlance.functions.literal import as_list, as_map, field, field_text, is_string, read_literal, read_value
from parlance.functions.text import bind, split_on, strip


def speaker_label(speaker: Column, user_speakers=V.USER_SPEAKERS, bot_speakers=V.BOT_SPEAKERS) -> Column:
    """``user``, ``bot``, or the speaker's own name in lower case."""
    name = strip(F.lower(speaker))
    return F.when(name.isin(*user_speakers), "user").when(name.isin(*bot_speakers), "bot").otherwise(name)


def message_text(text: Column) -> Column:
    """Message text on one line."""
    one_line = F.replace(F.replace(text, F.lit("\n\n"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    return strip(one_line)


def _wrapped_in(text: Column, opening: str, closing: str) -> Column:
    return F.startswith(text, F.lit(opening)) & F.endswith(text, F.lit(closing))


def parse_messages(conversation: Column, whole_bytes: int = WHOLE_BYTES) -> Column:
    """Conversation text -> ``array<struct<speaker, text>>``, null when it is not structured.

    Reads JSON and Python-literal text of any size; enveloped or plain messages; a
    list, a tagged list or a single message. Elements that are no message are
    skipped. Cells above ``whole_bytes`` are cut into their messages first.
    """
    return _messages_of(strip(conversation), whole_bytes)


def _is_structured(text: Column) -> Column:
    return _wrapped_in(text, "[", "]") | _wrapped_in(text, "{", "}")


def _messages_of(text: Column, whole_bytes: int = WHOLE_BYTES) -> Column:
    # The only member of a tagged list is its list.
    tagged = bind(split_members(text), lambda m: F.when(
        (F.size(m) == 1) & F.get(m, F.lit(0))["key"].isin('"L"', "'L'"), split_list(F.get(m, F.lit(0))["value"])))
    parts = F.when(F.octet_length(text) > whole_bytes, F.coalesce(split_list(text), tagged))

    def of_whole(value: Column) -> Column:
        return F.coalesce(as_list(value), as_list(field(value, "L")), F.when(as_map(value).isNotNull(), F.array(value)))

    elements = F.when(_is_structured(text), bind(parts, lambda found: read_parts(text, found, read_value, of_whole)))

    def member(element: Column, name: str) -> Column:
        return F.coalesce(
            field_text(element, name, "S"), field_text(element, name),
            field_text(element, "M", name, "S"), field_text(element, "M", name),
        )

    messages = F.transform(
        elements, lambda e: F.struct(member(e, "from").alias("speaker"), member(e, "text").alias("text"))
    )
    return F.filter(messages, lambda m: m["speaker"].isNotNull() | m["text"].isNotNull())


def join_messages(messages: Column) -> Column:
    """``array<struct<speaker, text>>`` -> transcript."""
    lines = F.transform(
        messages,
        lambda m: F.concat(
            F.coalesce(speaker_label(m["speaker"]), F.lit("")), F.lit(": "), F.coalesce(message_text(m["text"]), F.lit(""))
        ),
    )
    return F.array_join(lines, V.PART_SEPARATOR)


def _is_blank_cell(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).isin("", *V.BLANK_WORDS_EXACT)


def _too_large(text: Column, whole_bytes: int) -> Column:
    # A large cell that can be cut into elements is a list, whatever reading an element meets.
    return (F.octet_length(text) > whole_bytes) & split_list(text).isNotNull()


def transcript(conversation: Column, whole_bytes: int = WHOLE_BYTES) -> Column:
    """Conversation text -> transcript. Unstructured text passes through; blank gives ``''``.

    A list with a message that is itself too large to be read gives null;
    :func:`cell_status` names such cells. It is never taken for plain text.
    """
    return bind(strip(conversation), lambda text: F.when(_is_blank_cell(text), F.lit("")).otherwise(F.coalesce(
        join_messages(_messages_of(text, whole_bytes)), F.when(~_too_large(text, whole_bytes), text))))


def cell_status(conversation: Column, whole_bytes: int = WHOLE_BYTES) -> Column:
    """What a conversation cell is: ``blank``, ``messages``, ``text`` or ``too_large``."""

    def of(text: Column) -> Column:
        read = _messages_of(text, whole_bytes).isNotNull()
        return (
            F.when(_is_blank_cell(text), "blank").when(read, "messages")
            .when(_too_large(text, whole_bytes), "too_large").otherwise("text")
        )

    return bind(strip(conversation), of)


def _speaker_texts(messages: Column, speaker: str) -> Column:
    mine = F.filter(
        messages,
        lambda m: is_string(field(m, "from"))
        & (field_text(m, "from") == speaker)
        & field(m, "text").isNotNull(),
    )
    texts = F.transform(mine, lambda m: strip(F.coalesce(field_text(m, "text"), F.lit(""))))
    return F.filter(texts, lambda t: t != "")


def json_questions(conversation: Column, whole_bytes: int = WHOLE_BYTES) -> Column:
    """Texts of the messages whose speaker is exactly ``user``, in order, repeats kept."""
    messages = bind(strip(conversation), lambda text: F.when(
        _wrapped_in(text, "[", "]"), read_list(text, whole_bytes=whole_bytes)))
    return F.coalesce(F.array_join(_speaker_texts(messages, "user"), V.PART_SEPARATOR), F.lit(""))


def role_text(conversation: Column, speaker: str, whole_bytes: int = WHOLE_BYTES) -> Column:
    """All texts of one speaker of a Python-literal list, joined by a space."""
    messages = bind(conversation, lambda text: read_list(text, read_literal, whole_bytes))
    return F.coalesce(F.array_join(_speaker_texts(messages, speaker), " "), F.lit(""))


def pieces(transcript_text: Column) -> Column:
    """Transcript -> its pieces, whatever separator form was used."""
    text = F.replace(transcript_text, F.lit(" || "), F.lit("|"))
    text = F.replace(text, F.lit(" | "), F.lit("|"))
    text = F.replace(text, F.lit("||"), F.lit("|"))
    text = F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" "))
    return split_on(text, "|")


def texts_after(transcript_pieces: Column, prefixes, lead: str = "") -> Column:
    """Texts behind one of the prefixes, in any case; white space may come first.

    ``lead`` names further characters that may come before the prefix.
    """
    pattern = rf"(?iu)^[{V.WHITESPACE_CLASS}{lead}]*+(?:{'|'.join(prefixes)})"
    mine = F.filter(transcript_pieces, lambda p: p.rlike(pattern))
    texts = F.transform(mine, lambda p: strip(F.regexp_replace(p, pattern, "")))
    return F.coalesce(F.filter(texts, lambda t: t != ""), F.array().cast("array<string>"))


def user_texts_of(transcript_pieces: Column, prefixes=V.USER_PREFIXES) -> Column:
    """Texts of the user among the pieces. Zero-width marks may precede the prefix."""
    return texts_after(transcript_pieces, prefixes, V.ZERO_WIDTH_CLASS)


def bot_texts_of(transcript_pieces: Column, prefixes=V.BOT_PREFIXES) -> Column:
    """Texts of the bot among the pieces."""
    return texts_after(transcript_pieces, prefixes)


def user_texts(transcript_text: Column) -> Column:
    """Texts of the user in a transcript."""
    return user_texts_of(pieces(transcript_text))


def bot_texts(transcript_text: Column) -> Column:
    """Texts of the bot in a transcript."""
    return bot_texts_of(pieces(transcript_text))


def _one_line(texts: Column) -> Column:
    return strip(F.regexp_replace(F.array_join(texts, " "), " {2,}", " "))


def user_text(transcript_text: Column, prefixes=V.USER_PREFIXES) -> Column:
    """All user texts of a transcript as one line."""
    return _one_line(texts_after(pieces(transcript_text), prefixes))


def bot_text(transcript_text: Column, prefixes=V.BOT_PREFIXES) -> Column:
    """All bot texts of a transcript as one line."""
    return _one_line(texts_after(pieces(transcript_text), prefixes))


def _prefixed(transcript_pieces: Column, prefixes, lead: str = "") -> Column:
    pattern = rf"(?iu)^[{V.WHITESPACE_CLASS}{lead}]*+(?:{'|'.join(prefixes)})"
    return F.size(F.filter(transcript_pieces, lambda p: p.rlike(pattern)))


def message_counts(conversation: Column, whole_bytes: int = WHOLE_BYTES) -> Column:
    """Conversation text -> ``struct<mensajes, de_usuario, de_bot, de_otros>``: whole messages by who wrote them.

    Messages of a list are counted as they are, whatever words or separators
    their texts hold. In unstructured text the pieces that begin with a speaker
    count; a piece without one continues the piece before it, and a text without
    any is one message of others. A blank cell has no messages; a list that
    cannot be read gives nulls, see :func:`cell_status`.
    """

    def counts(total: Column, user: Column, bot: Column) -> Column:
        return F.struct(total.alias("mensajes"), user.alias("de_usuario"), bot.alias("de_bot"),
                        (total - user - bot).alias("de_otros"))

    def of_messages(messages: Column) -> Column:
        speakers = F.transform(messages, lambda m: speaker_label(m["speaker"]))
        return bind(speakers, lambda names: counts(
            F.size(names), *(F.size(F.filter(names, lambda n: n == label)) for label in ("user", "bot"))))

    def of_text(text: Column) -> Column:
        found = F.struct(_prefixed(pieces(text), V.USER_PREFIXES, V.ZERO_WIDTH_CLASS).alias("user"),
                         _prefixed(pieces(text), V.BOT_PREFIXES).alias("bot"))
        return bind(found, lambda n: counts(F.greatest(n["user"] + n["bot"], F.lit(1)), n["user"], n["bot"]))

    none, unread = F.lit(0), F.lit(None).cast("int")
    return bind(strip(conversation), lambda text: bind(_messages_of(text, whole_bytes), lambda messages: (
        F.when(_is_blank_cell(text), counts(none, none, none))
        .when(messages.isNotNull(), of_messages(messages))
        .when(_too_large(text, whole_bytes), counts(unread, unread, unread))
        .otherwise(of_text(text)))))
