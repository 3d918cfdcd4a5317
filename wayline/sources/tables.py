"""Readers for lookup tables and address lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayline.functions.casts import strip_right
from wayline.functions.ip import ip_to_int
from wayline.sources.lines import read_position

# Field texts that mean "missing". NA is data: it is a country code.
MISSING = (
    "-1.#IND", "1.#QNAN", "1.#IND", "-1.#QNAN", "#N/A N/A", "#N/A", "N/A", "n/a", "#NA", "NULL",
    "null", "NaN", "-NaN", "nan", "-nan", "",
)

# Columns of the lookup tables, in file order.
COUNTRY_COLUMNS = ("latitude", "longitude", "country_code", "country_name")
PLACE_COLUMNS = (
    "country_code", "zip_code", "place_name", "admin_name1", "admin_code1", "admin_name2",
    "admin_code2", "admin_name3", "admin_code3", "latitude", "longitude", "accuracy",
)
IP_RANGE_COLUMNS = (
    "ip_from", "ip_to", "country_code", "country_name", "region_name", "place_name", "latitude",
    "longitude", "zip_code",
)
_NUMBERS = {"latitude": "double", "longitude": "double", "accuracy": "double", "ip_from": "bigint", "ip_to": "bigint"}


def _value(name: str) -> Column:
    text = F.col(name)
    present = F.when(~text.isin(*MISSING), text)
    if name in _NUMBERS:
        return F.trim(present).try_cast(_NUMBERS[name]).alias(name)
    return F.upper(present).alias(name)


def read_table(spark: SparkSession, path: str | list[str], columns: tuple[str, ...], separator: str = ",") -> DataFrame:
    """Headerless quoted CSV, gzip or plain, with upper-case text and typed numbers.

    Every column is read as text first, so the missing-value list is applied before
    any cast. Row positions are kept for :func:`wayline.sources.lines.with_order`.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = (
        spark.read.schema(schema).option("sep", separator).option("quote", '"').option("escape", '"')
        .option("encoding", "UTF-8").option("maxCharsPerColumn", -1).csv(path)
    )
    return raw.select(*[_value(c) for c in columns], read_position())


def read_countries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Country table: point, code, name."""
    return read_table(spark, path, COUNTRY_COLUMNS)


def read_places(spark: SparkSession, path: str | list[str], separator: str = ",") -> DataFrame:
    """Postal and place table."""
    return read_table(spark, path, PLACE_COLUMNS, separator)


def read_ip_ranges(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Address-range table."""
    return read_table(spark, path, IP_RANGE_COLUMNS)


def parse_address_lines(lines: DataFrame) -> DataFrame:
    """Add ``ip_int`` to lines holding one address each; null where it does not parse."""
    return lines.withColumn("ip_int", ip_to_int(strip_right(F.col("value"))))


def address_set(lines: DataFrame, counts: Observation | None = None) -> DataFrame:
    """Distinct addresses of a list; lines that do not parse are skipped.

    ``counts`` observes ``lines`` and ``bad_lines`` when the set is consumed; blank lines count as neither.
    """
    parsed = parse_address_lines(lines)
    if counts is not None:
        filled = strip_right(F.col("value")) != ""
        parsed = parsed.observe(
            counts, F.count_if(filled).alias("lines"), F.count_if(filled & F.col("ip_int").isNull()).alias("bad_lines")
        )
    return parsed.where(F.col("ip_int").isNotNull()).select("ip_int").distinct()


def read_relay_export(spark: SparkSession, path: str | list[str], exit_nodes: bool) -> DataFrame:
    """Addresses of a relay-status export with a header, by their exit flag."""
    wanted = "1" if exit_nodes else "0"
    return (
        spark.read.option("header", True).csv(path)
        .where(F.trim(F.col("`Flag - Exit`")) == wanted).select(F.col("`IP Address`"))
    )
