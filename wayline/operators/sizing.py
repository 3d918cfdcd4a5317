"""Broadcast only what was measured to be small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ROWS = 1_000_000
MAX_BYTES = 128 * 1024 * 1024
# What one task takes of a table whose rows grow into many.
SPREAD_ROWS = 50_000
SPREAD_BYTES = 16 * 1024 * 1024


def _field_bytes(field: T.StructField) -> Column:
    name = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 8
    if isinstance(field.dataType, T.ArrayType):
        return F.coalesce(F.octet_length(name.cast("string")), F.lit(0)) + 8
    return F.lit(8)


def row_bytes(df: DataFrame) -> Column:
    """Size of a row, from the text it holds."""
    total = F.lit(16).cast("bigint")
    for field in df.schema.fields:
        total = total + _field_bytes(field)
    return total


def is_small(df: DataFrame, rows_per_row: int = 1, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Measure a table: does it fit a broadcast when each row yields ``rows_per_row``?

    One aggregation over the table. Measure a stored table rather than one that is
    costly to derive.
    """
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return n * rows_per_row <= max_rows and size * rows_per_row <= max_bytes


def spread(df: DataFrame, *keys: str, rows: int = SPREAD_ROWS, size: int = SPREAD_BYTES) -> DataFrame:
    """Deal a table's rows over tasks by ``keys``, so many to a task that none holds more than
    about ``rows`` rows or ``size`` bytes; a table that fits one task stays as it is.

    A compressed file of a few MB is read by one task, whatever its rows grow into; and what
    that task writes is one file, which the next step again reads by one task. One aggregation
    over the table.
    """
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    tasks = max(-(-n // rows), -(-total // size))
    return df.repartition(tasks, *keys) if tasks > 1 else df


def hinted(df: DataFrame, small: bool) -> DataFrame:
    """Mark a measured-small table for broadcast. Otherwise the join shuffles, and
    adaptive execution splits the partitions of hot keys."""
    return F.broadcast(df) if small else df
