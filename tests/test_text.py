import random
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from parlance import fixed_values as V
from parlance.functions import text as tx, tokens as tk, transcript as tr


def test_whitespace_is_complete():
    assert set(V.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip_every_kind_of_space(evaluate):
    texts = [w + "a b" + w for w in V.WHITESPACE] + ["", "  ", "x"]
    assert evaluate(tx.strip, *texts) == [t.strip() for t in texts]


def test_blank(evaluate):
    texts = [None, "", " NaN ", "None", "null", "x", "nano"]
    assert evaluate(tx.is_blank, *texts) == [True, True, True, True, True, False, False]
    assert evaluate(tx.is_blank_exact, "nan", "NaN", "None", "none") == [True, False, True, False]


def _normalized(text):
    """Plain statement of the rule, for comparison."""
    text = re.sub(" +", " ", re.sub(r"[\n\r\t]", " ", text.strip())).replace("|", " | ")
    while " |  | " in text:
        text = text.replace(" |  | ", " | ")
    return text.strip()


def test_normalize_text(evaluate):
    rng = random.Random(5)
    alphabet = "ab ||\n\t\r\xa0"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 14))) for _ in range(1000)]
    assert evaluate(tx.normalize_text, *texts) == [_normalized(t) for t in texts]
    assert evaluate(tx.normalize_text, None) == [""]


def test_turn_count(evaluate):
    assert evaluate(tx.turn_count, "bot: robot", None, "", "user user bot") == [2, 1, 1, 2]
    assert evaluate(lambda c: tx.turn_count(c, floor=None), "hola", None) == [0, 1]


def test_preview_and_many(evaluate):
    assert evaluate(lambda c: tx.preview(c, 3), "añ😀", "abcd", None) == ["añ😀", "abc...", None]
    assert evaluate(tx.has_many, "a|b", "a", None) == [True, False, False]


def test_distinct_pieces(evaluate):
    assert evaluate(tx.distinct_pieces, "b | a | b |  | c", "", None) == ["b | a | c", "", ""]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab |", max_size=12), min_size=1, max_size=20))
def test_distinct_pieces_is_idempotent(evaluate, texts):
    once = evaluate(tx.distinct_pieces, *texts)
    assert evaluate(tx.distinct_pieces, *once) == once


def test_chars4(evaluate):
    assert evaluate(tk.chars4_tokens, "", "abc", "abcdefgh", None, "añ😀ñ") == [0, 1, 2, 0, 1]


def _estimate(text):
    n = len(text)
    if n == 0:
        return 0
    factor = 1
    factor += text.count(" ") / n * 0.2
    factor += sum(c in ".,;:!?¡¿()[]{}\"'-" for c in text) / n * 0.15
    factor += sum(c.isdigit() or c in "@#$%&*+=/<>" for c in text) / n * 0.1
    return max(1, int(n / 3.8 * factor))


def test_estimated_tokens(evaluate):
    rng = random.Random(3)
    alphabet = "abcñé ,.;:¿?¡!()[]{}\"'-0123456789²①٣@#$%&*+=/<>😀\n"
    texts = ["", "a"] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200))) for _ in range(300)]
    assert evaluate(tk.estimated_tokens, *texts) == [_estimate(t) for t in texts]


def test_every_digit_counts(evaluate):
    # 200 digits against 200 letters: the estimate differs, so a missed digit shows.
    digits = [chr(i) for i in range(0x110000) if chr(i).isdigit()]
    texts = [d * 380 for d in digits]
    found = evaluate(tk.estimated_tokens, *texts)
    missed = [hex(ord(d)) for d, n in zip(digits, found) if n != _estimate(d * 380)]
    # The database of the engine may be older than Python's; nothing below this plane may differ.
    assert [m for m in missed if int(m, 16) < 0x10000] == []


def test_list_tokens(evaluate):
    both = evaluate(lambda c: tk.estimated_tokens_of_all(F.split(c, ",")), "abcd,efgh,", "")
    assert both == [_estimate("abcd") + _estimate("efgh"), 0]


@pytest.mark.parametrize("text, users, bots", [
    ("Usr: a | bot: b || u: c", ["a", "c"], ["b"]),
    ("​user: z|USER:  |x", ["z"], []),
    ("usuario: a\tb\nc|Asistente: d", ["a b c"], ["d"]),
    ("", [], []),
    (None, [], []),
])
def test_texts_of_speakers(evaluate, text, users, bots):
    assert evaluate(tr.user_texts, text) == [users]
    assert evaluate(tr.bot_texts, text) == [bots]


def test_one_line_texts(evaluate):
    assert evaluate(tr.user_text, "user: a  b | u: c | bot: d") == ["a b c"]
    assert evaluate(tr.bot_text, "user: a | b: c   c | bot: d") == ["c c d"]
