"""Typed parsing of text fields: numbers, dates and the not-a-number test."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Declared types that are parsed as numbers.
NUMERIC_TYPES = ("integer", "long", "date", "float")

# Every character Python's str.rstrip() removes.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


# Every decimal digit of another script that Python's float() reads, and the digits they stand for.
_OTHER_DIGITS = "".join(c for c in map(chr, range(0x80, 0x110000)) if unicodedata.category(c) == "Nd")
_THEIR_VALUES = "".join(str(unicodedata.digit(c)) for c in _OTHER_DIGITS)

# Decimal number text as Python's float() accepts it, blanks around it
# included. Possessive, so junk after many digits fails at once.
_BLANKS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]*+"
_DIGITS = r"[0-9\p{Nd}]++(?:_[0-9\p{Nd}]++)*+"
_NUMBER = rf"^{_BLANKS}[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?{_BLANKS}\z"
_NOT_FINITE = rf"^{_BLANKS}[+-]?(?:inf|infinity|nan){_BLANKS}\z"


def strip_right(text: Column) -> Column:
    """Drop all trailing whitespace. Linear in the text; most lines end without any,
    which their last character tells."""
    ends_blank = F.substring(text, -1, 1).isin(*WHITESPACE)
    return F.when(ends_blank, F.rtrim(text, F.lit(WHITESPACE))).otherwise(text)


def is_nan_or_inf(value: Column) -> Column:
    """True for NaN and both infinities, null for null."""
    v = value.cast("double")
    return F.isnan(v) & v.isNotNull() | (F.abs(v) == F.lit(float("inf")))


def _number(text: Column) -> Column:
    """Spark's own cast, and again with plain digits and without underscores and unusual blanks if that fails."""
    plain = F.translate(text, _OTHER_DIGITS + "_" + WHITESPACE, _THEIR_VALUES).try_cast("double")
    return F.coalesce(text.try_cast("double"), plain)


def to_float(text: Column) -> Column:
    """Text to DOUBLE with Python's number grammar; null when it is not a number.

    Spark's own cast also takes ``1d``, ``1.0f`` and hexadecimal text and refuses
    digit underscores, so a pattern guards it.
    """
    special = F.lower(text).rlike(_NOT_FINITE)
    return F.when(text.rlike(_NUMBER) | special, _number(text))


def finite(text: Column) -> Column:
    """Text to a finite DOUBLE; null for '', non-numbers, NaN and infinities.

    Written without branches around the number, so Spark computes it once:
    multiplying by zero turns an infinity into NaN, which becomes null. Adding -0.0
    leaves every number as it is, the sign of zero included.
    """
    value = _number(text)
    valid = F.when(text.rlike(_NUMBER), F.lit(-0.0))
    return F.nanvl(value + value * 0.0 + valid, F.lit(None).cast("double"))


def to_date_ms(text: Column, in_seconds: bool = False) -> Column:
    """Epoch text to BIGINT milliseconds, truncated toward zero."""
    value = finite(text)
    return (value * 1000 if in_seconds else value).try_cast("bigint")


def seconds_text_to_ms(text: Column) -> Column:
    """Untyped seconds to milliseconds, kept as text.

    Three zeros are appended to the text. Fractional seconds, where appending would
    give a wrong number, are multiplied instead.
    """
    fractional = text.rlike(r"^\s*[+-]?[0-9]*\.[0-9]+\s*\z")
    scaled = to_date_ms(text, in_seconds=True).cast("string")
    return F.when(fractional, scaled).otherwise(F.concat(text, F.lit("000")))


def cast_text(text: Column, declared: str, dates_in_seconds: bool = False, exact_long: bool = False) -> Column:
    """Parse one text field by its declared type; other types keep their text.

    ``long`` goes through DOUBLE as declared types do, so values above 2^53 lose
    digits; ``exact_long`` keeps integral text exact.
    """
    if declared == "date":
        return to_date_ms(text, dates_in_seconds)
    if declared == "integer":
        return finite(text).try_cast("int")
    if declared == "long":
        via_double = finite(text).try_cast("bigint")
        if exact_long:
            return F.coalesce(text.try_cast("bigint"), via_double)
        return via_double
    if declared == "float":
        return finite(text)
    return text


def is_bad_number(text: Column, parsed: Column) -> Column:
    """True when non-empty text did not parse, NaN and infinities aside."""
    return parsed.isNull() & (text != "") & ~F.lower(text).rlike(_NOT_FINITE)
