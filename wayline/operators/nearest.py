"""Nearest member of named point sets, by descending a grid with bounding boxes.

Each set's points lie in cells of a world grid, every cell divided into 16 x 16 at the next of
:data:`LEVELS` levels. A cell knows the box its points really span. For an asked point the least
and the most distance to a box bound those to its members, so per level only cells that can hold
the nearest one stay open: a handful, whatever the size of the set. Boxes decide, not the grid's
geometry, so points outside the world's range are found too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.scratch import stored

LEVELS = 3
_SPLIT_BITS = 4
_SIDE = 1 << (_SPLIT_BITS * LEVELS)


def _finest(value: Column, low: float, span: float) -> Column:
    place = F.floor((value - low) / span * _SIDE)
    return F.greatest(F.lit(0), F.least(place, F.lit(_SIDE - 1))).cast("bigint")


def _parent(cell: Column) -> Column:
    """The cell of the level above; a cell is its row and column in one number."""
    row, column = F.shiftright(cell, 32), cell.bitwiseAND(F.lit((1 << 32) - 1))
    return F.shiftleft(F.shiftright(row, _SPLIT_BITS), 32).bitwiseOR(F.shiftright(column, _SPLIT_BITS))


def _span(low: Column, high: Column, at: Column) -> tuple[Column, Column]:
    """Least and most distance on one axis."""
    return F.greatest(low - at, at - high, F.lit(0.0)), F.greatest(F.abs(low - at), F.abs(high - at))


def _boxed(points: DataFrame, lat: str, lon: str) -> tuple[DataFrame, list[DataFrame]]:
    """Points by set and finest cell, and per level the cells under each cell above."""
    cell = F.shiftleft(_finest(F.col("_lat"), -90.0, 180.0), 32).bitwiseOR(_finest(F.col("_lon"), -180.0, 360.0))
    leaves = stored(
        points.select("_name", F.col(lat).alias("_lat"), F.col(lon).alias("_lon"), "_row")
        .groupBy("_name", "_lat", "_lon").agg(F.min("_row").alias("_row"))
        .select("_name", cell.alias("_cell"), "_lat", "_lon", "_row"),
        "nearest_points",
    )
    box = [F.min("_lat").alias("lat0"), F.max("_lat").alias("lat1"), F.min("_lon").alias("lon0"), F.max("_lon").alias("lon1")]
    boxes = stored(leaves.groupBy("_name", "_cell").agg(*box), "nearest_boxes")
    outer = [
        F.min("lat0").alias("lat0"), F.max("lat1").alias("lat1"), F.min("lon0").alias("lon0"), F.max("lon1").alias("lon1"),
    ]
    levels = []
    for _ in range(LEVELS):
        children = boxes.groupBy("_name", _parent(F.col("_cell")).alias("_cell"))
        levels.append(children.agg(F.collect_list(F.struct("_cell", "lat0", "lat1", "lon0", "lon1")).alias("_children")))
        boxes = children.agg(*outer)
    return leaves, levels[::-1]


def nearest_members(asked: DataFrame, points: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """``_query, _near`` (lat, lon): the member nearest to (``_center_lat``, ``_center_lon``) of the
    sets listed in ``_names``; the lowest row id of equally near ones.

    ``points`` holds the members as ``_name``, the coordinates and ``_row``; rows without coordinates
    must be left out. Rows moved grow with the points and, times a few open cells, with the queries.
    """
    leaves, levels = _boxed(points, lat, lon)
    key = ["_query", "_center_lat", "_center_lon"]
    open_cells = asked.select(*key, F.explode("_names").alias("_name"), F.lit(0).cast("bigint").alias("_cell"))
    for children in levels:

        def bounds(c: Column) -> Column:
            near_lat, far_lat = _span(c["lat0"], c["lat1"], F.col("_center_lat"))
            near_lon, far_lon = _span(c["lon0"], c["lon1"], F.col("_center_lon"))
            return F.struct(
                F.col("_name"), c["_cell"].alias("_cell"), (near_lat * near_lat + near_lon * near_lon).alias("near"),
                (far_lat * far_lat + far_lon * far_lon).alias("far"),
            )

        met = open_cells.join(children, ["_name", "_cell"]).withColumn("_bounds", F.transform("_children", bounds))
        met = met.withColumn("_bound", F.array_min(F.transform("_bounds", lambda b: b["far"])))
        possible = F.filter("_bounds", lambda b: b["near"] <= F.col("_bound"))
        gathered = met.select(*key, "_bound", possible.alias("_possible")).groupBy(*key).agg(
            F.min("_bound").alias("_bound"), F.flatten(F.collect_list("_possible")).alias("_possible")
        )
        kept = F.filter("_possible", lambda b: b["near"] <= F.col("_bound"))
        open_cells = gathered.select(*key, F.explode(kept).alias("_open")).select(*key, "_open._name", "_open._cell")
    d_lat, d_lon = F.col("_lat") - F.col("_center_lat"), F.col("_lon") - F.col("_center_lon")
    found = open_cells.join(leaves, ["_name", "_cell"]).groupBy("_query").agg(
        F.min(F.struct((d_lat * d_lat + d_lon * d_lon).alias("d"), "_row", "_lat", "_lon")).alias("_best")
    )
    return found.select("_query", F.struct(F.col("_best._lat").alias("lat"), F.col("_best._lon").alias("lon")).alias("_near"))
