"""Type conversions and prices. A value that cannot be converted becomes null."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from parlance import fixed_values as V
from parlance.functions.text import bind, strip

# First and last millisecond of the years 1 to 9999, and the widest clock value.
_FIRST_MS, _LAST_MS = -62135596800000, 253402300799999
_CLOCK_SECONDS = 2**63


def to_timestamp(text: Column, formats: tuple[str, ...] = ()) -> Column:
    """Timestamp text -> timestamp without zone; each row is read on its own.

    ISO forms are tried first, then ``formats`` in order. A zone in the text is
    dropped, so the local date and time stay as written.
    """
    text = strip(text)
    tries = [text.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def to_day(text: Column, formats: tuple[str, ...] = ()) -> Column:
    """Timestamp text -> date."""
    return F.to_date(to_timestamp(text, formats))


def date_label(day: Column, missing: str = V.NO_DATE) -> Column:
    """Date -> ``DD/MM/YYYY`` text."""
    return F.coalesce(F.date_format(day, V.REPORT_DATE_FORMAT), F.lit(missing))


def parse_date(text: Column) -> Column:
    """Date text in one of several formats -> date."""
    out = F.when(text.isNull() | (text == ""), F.lit(None).cast("date"))
    for pattern, form in V.DATE_FORMATS:
        out = out.when(text.rlike(pattern), F.try_to_date(text, form))
    return out.otherwise(text.try_cast("date"))


def parse_timestamp(text: Column) -> Column:
    """Timestamp text -> timestamp; blank gives null."""
    return F.when(text != "", F.try_to_timestamp(text))


def parse_integer(text: Column) -> Column:
    """Integer text -> int; blank and ``0`` give null."""
    return F.when((text != "") & (text != "0"), text.try_cast("int"))


def parse_double(text: Column) -> Column:
    """Number text -> double; blank gives null."""
    return F.when(text != "", text.try_cast("double"))


def in_domain(text: Column, domain=V.FEEDBACK_CLASSES) -> Column:
    """The value in lower case without outer spaces, null outside the domain."""
    value = F.lower(F.trim(text))
    return F.when(value.isin(*domain), value)


def only_with(text: Column, guard: Column, domain=V.FEEDBACK_CLASSES) -> Column:
    """Keep a value only where its guard column is in the domain."""
    return F.when(in_domain(guard, domain).isNotNull(), text.cast("string"))


def _whole_number(text: Column) -> Column:
    # The pattern comes first: a failing cast costs far more than a match.
    return F.when(text.rlike(r"^[+-]?\d{1,18}$"), text.cast("bigint"))


def epoch_ms(raw: Column) -> Column:
    """Epoch milliseconds -> bigint; null unless it is a time in the years 1 to 9999."""
    return bind(
        _whole_number(strip(raw.cast("string"))),
        lambda n: F.when(n.between(_FIRST_MS, _LAST_MS) & (n != 0), n),
    )


def epoch_status(raw: Column) -> Column:
    """``missing`` (or zero), ``invalid``, ``error`` (beyond any clock) or ``ok``."""
    return bind(strip(raw.cast("string")), lambda text: bind(_whole_number(text), lambda n: _status(text, n)))


def _status(text: Column, number: Column) -> Column:
    # Only whole numbers too long for a bigint need the decimal.
    beyond = F.coalesce(
        F.abs(text.try_cast("decimal(38,0)")) >= F.lit(Decimal(_CLOCK_SECONDS * 1000)), F.lit(True)
    )
    return (
        F.when(F.coalesce(text, F.lit("")) == "", "missing")
        .when(number == 0, "missing")
        .when(number.between(_FIRST_MS, _LAST_MS), "ok")
        .when(number.isNull() & text.rlike(r"^[+-]?\d+$") & beyond, "error")
        .otherwise("invalid")
    )


def epoch_label(raw: Column) -> Column:
    """Epoch milliseconds -> ``yyyy-MM-dd HH:mm:ss`` text in UTC."""
    moment = F.timestamp_add("MILLISECOND", epoch_ms(raw), F.lit("1970-01-01").cast("timestamp_ntz"))
    without_time = bind(epoch_status(raw), lambda status: F.when(status == "missing", "").when(
        status == "error", V.ERROR_DATE
    ).otherwise(V.INVALID_DATE))
    return F.coalesce(F.date_format(moment, "yyyy-MM-dd HH:mm:ss"), without_time)


def token_price(tokens: Column, rate: str) -> Column:
    """Price of a token count as decimal, rounded to millionths."""
    return F.round(tokens.cast("decimal(18,0)") * F.lit(Decimal(rate)) / F.lit(Decimal(1000)), 6).cast("decimal(24,6)")
