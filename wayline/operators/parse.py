"""Positional parsing of delimited lines, typed casts and reject handling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.config import ImportConfig
from wayline.functions.casts import (
    NUMERIC_TYPES,
    cast_text,
    is_bad_number,
    seconds_text_to_ms,
    strip_right,
)
from wayline.sources.lines import POSITION

LINE = "_line"
REASON = "_reject_reason"
BAD_FIELDS = "_bad_fields"

_REGEX_CHARACTERS = "\\.$|()[]{}^?*+"


def _literal_pattern(separator: str) -> str:
    if not separator:
        raise ValueError("the separator is empty")
    if len(separator) == 1:
        return "\\" + separator if separator in _REGEX_CHARACTERS else separator
    return "\\Q" + separator.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split_line(line: Column, separator: str = ";") -> Column:
    """Fields of a line: trailing whitespace dropped, then a literal split."""
    return F.split(strip_right(line), _literal_pattern(separator), -1)


def parse_lines(
    lines: DataFrame,
    columns: Sequence[str],
    separator: str = ";",
    required: Sequence[str] = (),
    value: str = "value",
) -> DataFrame:
    """Name the fields of each line by position, as text.

    A short line leaves its trailing columns null, an empty field is ''. A line with
    too many fields, or without one of the ``required`` columns, carries a reason in
    ``_reject_reason``. Other input columns are kept.
    """
    kept = [c for c in lines.columns if c not in (value, POSITION)]
    clash = set(kept + [LINE, REASON, BAD_FIELDS]) & set(columns)
    if clash:
        raise ValueError(f"declared columns collide with input columns: {sorted(clash)}")
    fields = F.col("_fields")
    needed = max((list(columns).index(c) + 1 for c in required), default=0)
    reason = F.when(F.size(fields) > len(columns), F.lit("too many fields")).when(
        F.size(fields) < needed, F.lit("missing id field")
    )
    # The one-element explode keeps filters on the fields from repeating the split.
    once = F.explode(F.array(split_line(F.col(value), separator))).alias("_fields")
    split = lines.select(*kept, F.col(value).alias(LINE), once)
    return split.select(
        *kept,
        *[F.get(fields, F.lit(i)).alias(c) for i, c in enumerate(columns)],
        F.col(LINE),
        reason.alias(REASON),
    )


def cast_columns(
    parsed: DataFrame,
    types: Mapping[str, str],
    dates_in_seconds: bool = False,
    exact_long: bool = False,
) -> DataFrame:
    """Parse text columns by declared type and list the ones that failed in ``_bad_fields``.

    A value that does not parse becomes null; its row is kept.
    """
    casts = {
        c: cast_text(F.col(f"`{c}`"), t, dates_in_seconds, exact_long)
        for c, t in types.items()
        if c in parsed.columns
    }
    failed = [
        F.when(is_bad_number(F.col(f"`{c}`"), cast), F.lit(c)) for c, cast in casts.items() if types[c] in NUMERIC_TYPES
    ]
    none = F.array(F.lit(None).cast("string"))
    bad = F.array_except(F.array(*failed), none) if failed else F.array().cast("array<string>")
    return parsed.select(
        *[casts.get(c, F.col(f"`{c}`")).alias(c) for c in parsed.columns if c != BAD_FIELDS], bad.alias(BAD_FIELDS)
    )


def parse_typed(lines: DataFrame, cfg: ImportConfig, separator: str = ";", dates_in_seconds: bool = False,
                exact_long: bool = False, required: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Parse and cast by the declared types."""
    parsed = parse_lines(lines, cfg.order_in_file, separator, required, value)
    return cast_columns(parsed, {c: cfg.properties[c] for c in cfg.order_in_file}, dates_in_seconds, exact_long)


def parse_untyped(lines: DataFrame, cfg: ImportConfig, separator: str = ";", required: Sequence[str] = (),
                  value: str = "value") -> DataFrame:
    """Parse and keep every value as text."""
    return parse_lines(lines, cfg.order_in_file, separator, required, value)


def dates_to_ms(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn untyped date columns from seconds to milliseconds text."""
    return df.withColumns({c: seconds_text_to_ms(F.col(f"`{c}`")) for c in columns}) if columns else df


def accepted(parsed: DataFrame) -> DataFrame:
    """Rows that parsed, without the bookkeeping columns."""
    return parsed.where(F.col(REASON).isNull()).drop(LINE, REASON, BAD_FIELDS)


def rejected(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Lines that did not parse, with the reason and the ``keep`` columns."""
    return parsed.where(F.col(REASON).isNotNull()).select(
        *keep, F.col(LINE).alias("line"), F.col(REASON).alias("reason")
    )


def first_rejected(rejects: DataFrame, order: str, limit: int = 1000) -> DataFrame:
    """Earliest ``limit`` rejects, for a report."""
    return rejects.orderBy(order).limit(limit)


def apply_reject_policy(parsed: DataFrame, policy: str = "collect") -> tuple[DataFrame, DataFrame | None]:
    """Split into good rows and rejects.

    ``collect`` returns both, ``drop`` returns the good rows alone, ``fail`` makes the
    job raise at the first reject.
    """
    if policy == "collect":
        return accepted(parsed), rejected(parsed)
    if policy == "drop":
        return accepted(parsed), None
    if policy == "fail":
        message = F.concat(F.lit("line rejected: "), F.col(REASON), F.lit(": "), F.col(LINE))
        checked = parsed.withColumn(REASON, F.when(F.col(REASON).isNotNull(), F.raise_error(message).cast("string")))
        return accepted(checked), None
    raise ValueError(f"unknown reject policy {policy!r}")


def with_constants(df: DataFrame, constants: Mapping[str, str]) -> DataFrame:
    """Add constant text columns; a column of the same name is overwritten."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()}) if constants else df
