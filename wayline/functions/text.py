"""Word splitting with case and accent folding, and number-to-text formatting."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_BETWEEN_WORDS = r"[^\p{L}\p{N}\p{Co}]+"


def _accent_table() -> tuple[str, str]:
    """Letters that are one base letter plus one mark, and their base letters.

    Built from the Unicode decompositions. Combining marks come last and have no
    counterpart, so ``translate`` deletes them.
    """
    accented, base = [], []
    for code in range(0x00C0, 0x2000):
        letter = chr(code)
        parts = unicodedata.normalize("NFD", letter)
        if len(parts) == 2 and unicodedata.combining(parts[1]) and letter.lower() == letter:
            accented.append(letter)
            base.append(parts[0])
    marks = [chr(code) for code in range(0x0300, 0x0332)]
    return "".join(accented + marks), "".join(base)


ACCENTED, BASE = _accent_table()


def fold(text: Column) -> Column:
    """Lower-case text without accents."""
    return F.translate(F.lower(text), ACCENTED, BASE)


def words(text: Column) -> Column:
    """Folded words of a text in order; an empty array for null."""
    parts = F.split(fold(F.coalesce(text.cast("string"), F.lit(""))), _BETWEEN_WORDS, -1)
    return F.filter(parts, lambda w: w != "")


def coordinate_text(value: Column) -> Column:
    """DOUBLE below 1e7 to the text Python prints.

    Java switches to exponents below 1e-3, Python below 1e-4 and with two exponent
    digits; the digits themselves agree.
    """
    v = value.cast("double")
    java = v.cast("string")
    short = F.rtrim(java.try_cast("decimal(38,24)").cast("string"), F.lit("0"))
    tiny = F.regexp_replace(F.regexp_replace(java, r"(?:\.0)?E-([0-9])$", "e-0$1"), r"(?:\.0)?E", "e")
    return F.when((v == 0) | (F.abs(v) >= 1e-3), java).when(F.abs(v) >= 1e-4, short).otherwise(tiny)


def location_text(lat: Column, lon: Column) -> Column:
    """``lat,lon`` text of a point; null when either is missing."""
    return F.concat(coordinate_text(lat), F.lit(","), coordinate_text(lon))
