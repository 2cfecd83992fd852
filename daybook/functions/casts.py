"""Typing of delimited text, and the few text forms the reports need."""

from __future__ import annotations

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

from daybook.schemas import MONEY


def _column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _checked(text: Column, value: Column, ok: Column, kind: str, what: str) -> Column:
    """``value``, or an error naming the text when it is given but not usable."""
    problem = F.concat(F.lit(f"not {what}: "), text)
    return F.when(text.isNull() | ok, value).otherwise(F.raise_error(problem).cast(kind))


def parse_date(column: str | Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to date. Malformed text raises; NULL stays NULL."""
    text = _column(column)
    day = F.to_date(text, pattern)
    return _checked(text, day, day.isNotNull(), "date", f"a date as {pattern}")


def _digits(column: str | Column, digits: int, kind: str) -> Column:
    text = _column(column)
    value = text.try_cast("long")
    fits = F.coalesce(F.abs(value) < F.lit(10**digits), F.lit(False))
    return _checked(text, value, fits, "long", f"a number of {digits} digits").cast(kind)


def parse_key(column: str | Column) -> Column:
    """Text of at most ten digits to a surrogate key."""
    return _digits(column, 10, "long")


def parse_integer(column: str | Column, digits: int) -> Column:
    """Text of at most ``digits`` digits to int."""
    return _digits(column, digits, "int")


def parse_number(column: str | Column, kind: T.DecimalType = MONEY) -> Column:
    """Text to an exact decimal. Malformed or too large text raises."""
    text = _column(column)
    value = text.try_cast(kind)
    return _checked(text, value, value.isNotNull(), kind.simpleString(), "a number")


def money(column: str | Column) -> Column:
    """Cast to the amount type; digits past the eighth round half away from zero."""
    return _column(column).cast(MONEY)


def fixed_scale_text(column: str | Column, scale: int = 8) -> Column:
    """Number as text with a fixed count of decimals, no grouping, no exponent."""
    return F.regexp_replace(F.format_number(column, scale), ",", "")


def text_message(*parts: str | Column) -> Column:
    """Join literal texts and columns into one message; NULL parts are skipped."""
    return F.concat_ws(
        "",
        *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts],
    )


def moscow_time(utc: str | Column) -> Column:
    """Wall-clock time in Moscow of a time without a zone in UTC, also without a zone."""
    return F.convert_timezone(
        F.lit("UTC"), F.lit("Europe/Moscow"), _column(utc).cast("timestamp_ntz")
    )


def moscow_now() -> Column:
    """Current wall-clock time in Moscow, without a zone."""
    return F.convert_timezone(
        F.current_timezone(), F.lit("Europe/Moscow"), F.localtimestamp()
    )


def _upper_half(encoding: str) -> tuple[str, str]:
    raw = bytes(range(128, 256))
    decoded = raw.decode(encoding, errors="replace")
    if len(decoded) != len(raw):
        raise ValueError(f"{encoding} is not a single-byte code page")
    return raw.decode("latin-1"), decoded


def code_page_text(column: str | Column, encoding: str) -> Column:
    """Re-read text that was decoded as Latin-1 in the code page it was written in."""
    latin, target = _upper_half(encoding)
    return F.translate(column, latin, target)


def to_code_page_bytes(column: str | Column, encoding: str) -> Column:
    """The reverse of ``code_page_text``: text whose Latin-1 bytes are ``encoding``."""
    latin, target = _upper_half(encoding)
    pairs = [(t, l) for t, l in zip(target, latin) if t != "�"]
    return F.translate(column, "".join(t for t, _ in pairs), "".join(l for _, l in pairs))
