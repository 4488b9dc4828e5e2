"""Secret scans: fixed patterns, and a battery of randomness tests.

Patterns give the base spans. Beyond them, every run of 20 or more characters
of a text encoding is a candidate, and so are its parts of that length between
the marks + and /, between - and _, and between all four: a key can stand in a
path or behind a name. The encoding of a candidate is the smallest of a fixed
list that holds all its characters (a run with marks of both kinds has none and
is judged by its parts), and its symbols are numbered in that alphabet.

*Is it random?* Three tests of uniform random symbols are combined by Fisher's
method: chi-squared uniformity over groups of the alphabet, Wald-Wolfowitz runs
around the middle of the alphabet, and lag-one serial correlation. A candidate
that the battery rejects is patterned (repeats, sequences), not a key.

*Could it be ordinary text?* The likelihood ratio between uniform symbols and a
small model of ordinary words (letter frequencies, and classes that rarely
change inside a word) bounds the chance that ordinary text looks as random:
P(ratio >= r) <= 1 / r. The ratio grows with the length, so the bound knows how
little a short token proves. Benjamini-Hochberg over the candidates of a
document keeps the expected share of false discoveries below ``FALSE_SHARE``.

Defined results: a null or empty text has no spans. Positions are code points,
end exclusive. Candidates that overlap a base span are left out; base spans
always stay. Found candidates that overlap each other become one span. Runs of
digits alone are numbers, not candidates.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from parlance.llm.storage import text_batches

# --- Fixed values: the base patterns -------------------------------------------
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run shorter than 16 would be dropped, so only longer ones are matched.
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_CHARS = 12
ACCESS_CHARS = 18
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")

# --- Fixed values: encodings, smallest first -------------------------------------
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = {
    "hex": DIGITS + "abcdef",
    "hex upper": DIGITS + "ABCDEF",
    "lower": LOWER,
    "upper": UPPER,
    "base32": UPPER + "234567",
    "base36": DIGITS + LOWER,
    "base36 upper": DIGITS + UPPER,
    "base52": UPPER + LOWER,
    "base62": UPPER + LOWER + DIGITS,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
PARTS = tuple(map(re.compile, (r"[A-Za-z0-9_-]{20,}", r"[A-Za-z0-9+/]{20,}", r"[A-Za-z0-9]{20,}")))

# --- Fixed values: letters of ordinary text, in per mille ---------------------------
LETTER_FREQUENCY = {
    "a": 82, "b": 15, "c": 28, "d": 43, "e": 127, "f": 22, "g": 20, "h": 61, "i": 70, "j": 2, "k": 8, "l": 40,
    "m": 24, "n": 67, "o": 75, "p": 19, "q": 1, "r": 60, "s": 63, "t": 91, "u": 28, "v": 10, "w": 24, "x": 2,
    "y": 20, "z": 1,
}
STAY = 0.9  # chance that the next character of ordinary text is of the same class

NOT_RANDOM = 1e-3
FALSE_SHARE = 1e-3

_ORDER = {name: {c: i for i, c in enumerate(alphabet)} for name, alphabet in ENCODINGS.items()}
_SETS = {name: frozenset(alphabet) for name, alphabet in ENCODINGS.items()}
_CLASS = {c: k for k, chars in enumerate((LOWER, UPPER, DIGITS, "+/_-")) for c in chars}
_INSIDE = {c: math.log(LETTER_FREQUENCY[c.lower()] / sum(LETTER_FREQUENCY.values())) for c in LOWER + UPPER}
_INSIDE.update({c: math.log(1 / 10) for c in DIGITS})
_INSIDE.update({c: math.log(1 / 4) for c in "+/_-"})


def encoding_of(token: str) -> str | None:
    """Name of the smallest encoding that holds all characters; None for plain numbers."""
    chars = set(token)
    if chars <= set(DIGITS):
        return None
    return next((name for name, alphabet in _SETS.items() if chars <= alphabet), None)


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _two_sided(z: float) -> float:
    return min(1.0, 2 * _normal_tail(abs(z)))


def _chi_tail(x: float, freedom: int) -> float:
    """Upper tail of chi-squared by the cube-root approximation."""
    if x <= 0:
        return 1.0
    spread = 2 / (9 * freedom)
    return _normal_tail(((x / freedom) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))


def uniformity(symbols: np.ndarray, size: int) -> float:
    """Chi-squared test over equal stretches of the alphabet, at least five symbols expected in each."""
    groups = max(2, min(size, len(symbols) // 5))
    place = symbols * groups // size
    expected = np.bincount(np.arange(size) * groups // size, minlength=groups) * len(symbols) / size
    found = np.bincount(place, minlength=groups)
    return _chi_tail(float(((found - expected) ** 2 / expected).sum()), groups - 1)


def runs(symbols: np.ndarray, size: int) -> float:
    """Wald-Wolfowitz test of the runs above and below the middle of the alphabet."""
    high = symbols >= size // 2
    a, b = int(high.sum()), int((~high).sum())
    if not a or not b:
        return 2.0 ** (1 - len(symbols))
    n = a + b
    mean = 1 + 2 * a * b / n
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return _two_sided((1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(max(variance, 1e-9)))


def serial_correlation(symbols: np.ndarray) -> float:
    """Test of the correlation between neighbours."""
    x = symbols - symbols.mean()
    total = float((x * x).sum())
    if total == 0:
        return 0.0
    return _two_sided(float((x[1:] * x[:-1]).sum()) / total * math.sqrt(len(symbols)))


def randomness(token: str, encoding: str) -> float:
    """Fisher's combination of the battery: small if the symbols are not uniform random ones."""
    order = _ORDER[encoding]
    symbols = np.array([order[c] for c in token], np.int64)
    tests = (uniformity(symbols, len(order)), runs(symbols, len(order)), serial_correlation(symbols))
    half = -sum(math.log(max(p, 1e-300)) for p in tests)
    return min(1.0, math.exp(-half) * (1 + half + half * half / 2))


def ordinary(token: str, encoding: str) -> float:
    """Bound on the chance that ordinary text of this length looks as random as the token."""
    classes = [_CLASS[c] for c in token]
    stays = sum(a == b for a, b in zip(classes, classes[1:], strict=False))
    text = math.log(1 / 4) + stays * math.log(STAY) + (len(token) - 1 - stays) * math.log((1 - STAY) / 3)
    text += sum(_INSIDE[c] for c in token)
    return min(1.0, math.exp(min(0.0, text + len(token) * math.log(len(ENCODINGS[encoding])))))


def discoveries(chances: list[float], false_share: float = FALSE_SHARE) -> list[bool]:
    """Benjamini-Hochberg: which of the tests are discoveries."""
    ranked = sorted(range(len(chances)), key=chances.__getitem__)
    last = max((k for k, i in enumerate(ranked, 1) if chances[i] <= false_share * k / len(chances)), default=0)
    chosen = set(ranked[:last])
    return [i in chosen for i in range(len(chances))]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns, by start, then kind."""
    found = []
    lower = text.lower()
    if any(word in lower for word in KEYWORDS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=_by_start)


def _by_start(span: tuple[int, int, str]) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


def candidate_spans(text: str) -> list[tuple[int, int]]:
    """Runs of characters of the encodings and their long parts between marks, each once."""
    found = []
    for m in CANDIDATE.finditer(text):
        parts = {p.span() for pattern in PARTS for p in pattern.finditer(text, *m.span())}
        found += sorted(parts | {m.span()})
    return found


def random_spans(text: str, taken: list[tuple[int, int, str]] = ()) -> list[tuple[int, int, str]]:
    """Spans of the candidates that pass the battery and are discoveries; overlapping ones are one span."""
    candidates = []
    # What a pattern has found already is not tested: it would take part in the control of the others.
    begins, ends = [a for a, _, _ in taken], list(accumulate((b for _, b, _ in taken), max))
    for start, end in candidate_spans(text):
        before = bisect_left(begins, end)
        if before and ends[before - 1] > start:
            continue
        token = text[start:end]
        encoding = encoding_of(token)
        if encoding is not None:
            candidates.append((start, end, ordinary(token, encoding), randomness(token, encoding)))
    chosen = discoveries([c[2] for c in candidates])
    spans: list[tuple[int, int, str]] = []
    for (start, end, _, random), found in zip(candidates, chosen, strict=True):
        if found and random >= NOT_RANDOM:
            if spans and start < spans[-1][1]:
                start, end = spans[-1][0], max(end, spans.pop()[1])
            spans.append((start, end, "random"))
    return spans


def secret_spans(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and all spans."""
    text = text or ""
    base = base_spans(text)
    added = random_spans(text, base)
    return base, sorted(base + added, key=_by_start) if added else base


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


OUTPUT = pa.schema([
    ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
    ("base_sha256", pa.string()), ("spans", pa.string()), ("n_random", pa.int64()),
])
SCHEMA = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_random bigint"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            base, every = secret_spans(text.as_py())
            kinds = [kind for _, _, kind in every]
            rows.append({
                "doc_id": doc_id, **{f"n_{kind}": kinds.count(kind) for kind in KINDS},
                "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined(every),
            })
        yield pa.RecordBatch.from_pylist(rows, schema=OUTPUT)


def secrets(documents: DataFrame) -> DataFrame:
    """Per document: counts by kind and all spans."""
    text_batches(documents.sparkSession)
    return documents.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(_scan, SCHEMA)


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with a mark in place of every secret; overlapping spans become one."""
    if not text:
        return text
    out, done = [], 0
    for start, end, _ in secret_spans(text)[1]:
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]]) if out else text


def _redact_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [redact(text.as_py()) for text in batch.column("text")]
        at = batch.schema.get_field_index("text")
        columns = batch.columns
        columns[at] = pa.array(texts, batch.schema.field(at).type)
        if (size := batch.schema.get_field_index("n_chars")) >= 0:
            kind = batch.schema.field(size).type
            columns[size] = pa.array([None if t is None else len(t) for t in texts], kind)
        yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def redacted(documents: DataFrame) -> DataFrame:
    """All documents and columns, with secrets cut out of ``text`` and ``n_chars`` counted again."""
    text_batches(documents.sparkSession)
    return documents.mapInArrow(_redact_rows, documents.schema)
