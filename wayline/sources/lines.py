"""Readers that yield one text line per row, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNDECODABLE = "\ufffd"
# Never a character of a text, so it can stand for "no quote".
NONCHARACTER = "\uffff"


# Where a row was read: file and split offset. Only there when asked for.
POSITION = "_position"


def _clean(value: Column, decoded: bool) -> Column:
    """Drop bytes that are not UTF-8. The CSV reader has already put a replacement
    character for each; the text reader passes the bytes on."""
    dropped = F.translate(F.make_valid_utf8(value), UNDECODABLE, "")
    fine = ~value.contains(UNDECODABLE) if decoded else F.is_valid_utf8(value)
    return F.when(fine, value).otherwise(dropped)


def read_position() -> Column:
    """Position struct of a file scan."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")
    ).alias(POSITION)


def scan_lines(spark: SparkSession, path: str | list[str], skip_header: bool = False, stream: bool = False,
               max_files_per_trigger: int | None = None, positions: bool = False) -> DataFrame:
    """Lines of text files as column ``value``; bytes that are not UTF-8 are dropped.

    With ``skip_header`` the first line of each file is left out, and so are lines of
    blanks and control characters alone. The text stays whole: no quoting, no escaping. ``positions`` adds what
    :func:`with_order` needs.
    """
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if skip_header:
        reader = (
            reader.schema("value string, _whole string").option("columnNameOfCorruptRecord", "_whole").option("header", True).option("enforceSchema", True)
            .option("sep", "\u0001").option("quote", NONCHARACTER).option("escape", NONCHARACTER).option("comment", "")
            .option("maxCharsPerColumn", -1).option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
        # A line that holds the separator does not fit the schema, so the reader hands it over whole.
        lines = reader.csv(path).withColumn("value", F.coalesce("_whole", "value"))
    else:
        lines = reader.text(path)
    return lines.select(_clean(F.col("value"), decoded=skip_header).alias("value"), *([read_position()] if positions else []))


def with_order(rows: DataFrame, name: str = "seq") -> DataFrame:
    """Add the order of each row in its input: file, split offset, row counter.

    The struct compares in file order and holds the same order however the splits
    are spread over tasks. Batch only, since it counts rows.
    """
    order = F.struct(f"{POSITION}.file", f"{POSITION}.split", F.monotonically_increasing_id().alias("row"))
    kept = [c for c in rows.columns if c != POSITION]
    return rows.select(*kept, order.alias(name))


def generate_lines(ids: DataFrame, id_column: str = "id", start_ms: int = 1577836800000, separator: str = ";") -> DataFrame:
    """Synthetic access-log lines, one per id: time, position, address, service, message, status, duration.

    Time moves one second per id; the other fields are pseudo-random functions of the
    id, so a retried task makes the same lines again.
    """
    i = F.col(id_column).cast("bigint")
    n = F.pmod(i, F.lit(2147483648))
    address = F.pmod(n * 2654435761 + 12345, F.lit(4294967296))
    octets = [F.shiftright(address, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    lat = (F.pmod(n * 7727, F.lit(18001)) - 9000) / 100.0
    lon = (F.pmod(n * 15667, F.lit(36001)) - 18000) / 100.0
    line = F.concat_ws(
        separator,
        (i * 1000 + start_ms).cast("string"),
        F.format_string("%.2f,%.2f", lat.cast("double"), lon.cast("double")),
        F.concat_ws(".", *octets),
        F.concat(F.lit("service-"), F.pmod(n, F.lit(40)).cast("string")),
        F.concat(F.lit("request "), i.cast("string"), F.lit(" answered by node "), F.pmod(n, F.lit(97)).cast("string")),
        (F.pmod(n * 7919, F.lit(5)) * 100 + 100).cast("string"),
        F.format_string("%.3f", (F.pmod(n * 104729, F.lit(9999991)) / 1000.0).cast("double")),
    )
    return ids.select(i.alias("id"), line.alias("value"))
