"""First match and representative point of unions of row sets, without listing the unions.

A query asks for the rows of any of its named sets. Count and coordinate sums of a union follow
from those of the sets and of their overlaps by inclusion and exclusion, its first row is the
first of any set, and the point nearest to its centroid the nearest of any set. So each set and
each overlap that occurs is read once, however many queries ask for it; a row belongs to as many
overlaps as its keys have subsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.operators.first_match import centroid, coordinate_sums, finished
from wayline.operators.nearest import nearest_members


def subsets(names: Column) -> Column:
    """All non-empty subsets of an array, in its order."""
    masks = F.sequence(F.lit(1), F.pow(F.lit(2), F.size(names)).cast("int") - 1)
    return F.transform(
        masks, lambda mask: F.filter(names, lambda _, i: F.call_function("shiftright", mask, i).bitwiseAND(F.lit(1)) == 1)
    )


def set_totals(rows: DataFrame, lat: str, lon: str) -> DataFrame:
    """Count and coordinate sums of each set's points, and its first row; partially aggregated."""
    point = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    return rows.groupBy("_name").agg(
        F.min("_row").alias("_first"), F.count(F.when(point, F.lit(1))).alias("_points"), *coordinate_sums(lat, lon)
    )


def first_match_of_union(
    asked: DataFrame,
    overlaps: DataFrame,
    rows: DataFrame,
    attributes: Sequence[str],
    source: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    row_id: str = "row_id",
) -> DataFrame:
    """Answer per ``_query``, as :func:`first_match` gives it for the union of its sets.

    ``asked`` lists the ``_names`` of the sets of each query. ``overlaps`` has a row per query
    and subset of its sets: ``_name`` of that subset's overlap, and ``_size``, how many sets it
    has. ``rows`` (stored) holds the members of all these as ``_name, _row`` and the
    coordinates; a set is an overlap of size 1 and goes by the same name. Attributes come from
    ``source`` by ``row_id``.
    """
    totals = set_totals(rows, lat, lon)
    odd = F.col("_size") % 2 == 1

    def signed(column: str) -> Column:
        return F.sum(F.when(odd, F.col(column)).otherwise(-F.col(column))).alias(column)

    first = overlaps.join(totals, "_name").groupBy("_query").agg(
        F.min("_first").alias("_first"), *[signed(c) for c in ("_points", "_sum_lat", "_sum_lon")]
    )
    middle = first.where("_points > 1").select("_query", *centroid()).join(asked, "_query")
    members = rows.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).join(
        asked.select(F.explode("_names").alias("_name")).distinct(), "_name", "left_semi"
    )
    nearest = nearest_members(middle, members, lat, lon)
    return finished(first, nearest, ["_query"], attributes, source, lat, lon, row_id)
