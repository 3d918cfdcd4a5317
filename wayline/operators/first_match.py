"""First matching row and representative point of groups of matches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.functions.text import location_text
from wayline.operators.sizing import hinted

# Sums of coordinates run in DECIMAL, so the centroid does not depend on row order.
_COORDINATE = "decimal(28,12)"
# Over how many partitions the rows of one key spread.
SALTS = 16


def first_match(
    rows: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    lat: str = "latitude",
    lon: str = "longitude",
    row_id: str = "row_id",
    source: DataFrame | None = None,
) -> DataFrame:
    """One row per key: attributes and ``location`` of the row with the lowest id, and
    the ``representative_point`` of all rows.

    The representative point is the point nearest to the centroid (planar, duplicates
    count, lowest id on ties). That takes two aggregations, both with map-side partial
    results, so a key holding most of the rows sends one row per task. The second one
    covers only keys with several rows; it meets the centroids on (key, salt), so the
    rows of one key spread over tasks.

    When many rows fall on a key, pass the table they come from as ``source``: the first
    pass then only finds the lowest id, by hash, and fetches that row's attributes.
    """
    keys = list(keys)
    point = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    if source is None:
        found = F.min_by(F.struct(*attributes, F.col(lat).alias("_lat"), F.col(lon).alias("_lon")), F.col(row_id))
    else:
        found = F.min(row_id)
    first = rows.groupBy(*keys).agg(
        found.alias("_first"),
        F.count(F.when(point, F.lit(1))).alias("_points"),
        *coordinate_sums(lat, lon),
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    middle = first.where("_points > 1").select(
        *keys,
        salts,
        *centroid(),
    )
    d_lat, d_lon = F.col(lat) - F.col("_center_lat"), F.col(lon) - F.col("_center_lon")
    distance = d_lat * d_lat + d_lon * d_lon
    salt = F.pmod(F.xxhash64(row_id), F.lit(SALTS)).cast("int")
    nearest = (
        rows.where(point).select(*keys, lat, lon, row_id, salt.alias("_salt"))
        .join(middle, [*keys, "_salt"]).groupBy(*keys)
        .agg(
            F.min_by(
                F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon")),
                F.struct(distance.alias("d"), F.col(row_id).alias("r")),
            ).alias("_near")
        )
    )
    return finished(first, nearest, keys, attributes, source, lat, lon, row_id)


def coordinate_sums(lat: str, lon: str) -> list[Column]:
    """Sums over the rows that have both coordinates."""
    point = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    return [
        F.sum(F.when(point, F.col(c).cast("double").try_cast(_COORDINATE))).alias(name)
        for c, name in ((lat, "_sum_lat"), (lon, "_sum_lon"))
    ]


def centroid() -> list[Column]:
    """Centroid of points whose sums and number are given."""
    return [
        (F.col("_sum_lat").cast("double") / F.col("_points")).alias("_center_lat"),
        (F.col("_sum_lon").cast("double") / F.col("_points")).alias("_center_lon"),
    ]


def finished(
    first: DataFrame,
    nearest: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    source: DataFrame | None,
    lat: str,
    lon: str,
    row_id: str,
) -> DataFrame:
    """Answers from the first row of each key (its id, if ``source`` is given) and the nearest point."""
    if source is not None:
        row = F.struct(*attributes, F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
        fetched = source.select(F.col(row_id).alias("_row_id"), row.alias("_row"))
        first = first.join(fetched, F.col("_first") == F.col("_row_id")).withColumn("_first", F.col("_row"))
    answers = first.join(nearest, list(keys), "left").select(
        *keys,
        *[F.col("_first").getField(a).alias(a) for a in attributes],
        location_text(F.col("_first._lat"), F.col("_first._lon")).alias("location"),
        location_text(F.col("_near.lat"), F.col("_near.lon")).alias("_middle"),
    )
    return answers.withColumn("representative_point", F.coalesce("_middle", "location")).drop("_middle")


def attach(
    probe: DataFrame,
    table: DataFrame,
    on: Sequence[tuple[Column, str]],
    columns: Sequence[str],
    prefix: str,
    small: bool,
    extra: Column | None = None,
) -> DataFrame:
    """Left join ``table`` (at most one row per key) and add ``columns`` with a prefix.

    ``on`` pairs probe expressions with table columns. A probe column of the same name
    is overwritten where the lookup hits and kept where it misses.
    """
    if not on:
        raise ValueError("no key to attach by")
    keyed = probe.withColumns({f"_p{i}": c for i, (c, _) in enumerate(on)})
    side = table.select(
        *[F.col(k).alias(f"_k{i}") for i, (_, k) in enumerate(on)],
        *[F.col(c).alias(f"_v_{c}") for c in columns],
        F.lit(True).alias("_hit"),
    )
    condition = reduce(lambda a, b: a & b, [F.col(f"_p{i}") == F.col(f"_k{i}") for i in range(len(on))])
    joined = keyed.join(hinted(side, small), condition if extra is None else condition & extra, "left")
    return joined.select(*_merged(probe.columns, columns, prefix))


def _merged(probe_columns: Sequence[str], columns: Sequence[str], prefix: str) -> list[Column]:
    added = {prefix + c: F.col(f"_v_{c}") for c in columns}
    kept = [
        F.when(F.col("_hit"), added.pop(c)).otherwise(F.col(f"`{c}`")).alias(c) if c in added else F.col(f"`{c}`")
        for c in probe_columns
    ]
    return kept + [value.alias(name) for name, value in added.items()]
