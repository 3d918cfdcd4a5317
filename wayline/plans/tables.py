"""Lookup-table builds. Each is written once and read by every later run."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wayline.operators.answers import AnswerStore
from wayline.operators.lookup import COUNTRY, key_answers
from wayline.operators.places import PlaceIndex, place_postings, place_rows, term_answers, term_frequency
from wayline.operators.ranges import (
    ATTRIBUTES,
    RangeTable,
    grid_cells,
    grid_profile,
    ip_range_table,
    overlapping_ranges,
)
from wayline.operators.sizing import MAX_BYTES, MAX_ROWS
from wayline.operators.tor import relay_table
from wayline.sources.lines import scan_lines, with_order
from wayline.sources.tables import address_set, read_countries, read_ip_ranges, read_places


def with_row_ids(table: DataFrame) -> DataFrame:
    """Add ``row_id``, a BIGINT that rises in file order.

    A range-partitioned sort puts the rows in file order over the partitions; the id is
    the partition number and the place within it. Store the result before using the id
    twice.
    """
    ordered = with_order(table, "_seq").orderBy("_seq.file", "_seq.split", "_seq.row")
    return ordered.drop("_seq").withColumn("row_id", F.monotonically_increasing_id())


def _stored(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def build_countries(spark: SparkSession, source: str, target: str, optional_keys: bool = True) -> DataFrame:
    """Country answers for every key subset, from the country CSV."""
    rows = _stored(with_row_ids(read_countries(spark, source)), f"{target}/rows")
    return _stored(key_answers(rows, COUNTRY, COUNTRY.keys, every_subset=optional_keys), f"{target}/answers")


def build_places(spark: SparkSession, source: str, target: str, separator: str = ",") -> PlaceIndex:
    """Place rows, postings, term frequencies and single-term answers, from the place CSV."""
    raw = _stored(with_row_ids(read_places(spark, source, separator)), f"{target}/raw")
    rows = _stored(place_rows(raw), f"{target}/rows")
    postings = _stored(place_postings(rows), f"{target}/postings")
    frequency = _stored(term_frequency(postings), f"{target}/frequency")
    return PlaceIndex(rows, postings, frequency, _stored(term_answers(rows, postings), f"{target}/answers"))


def open_places(spark: SparkSession, target: str, keep_answers: bool = False) -> PlaceIndex:
    """Places built earlier. With ``keep_answers`` the answers of queries are stored beside them
    and serve later batches and runs."""
    parts = [spark.read.parquet(f"{target}/{p}") for p in ("rows", "postings", "frequency", "answers")]
    return PlaceIndex(*parts, known=AnswerStore(spark, f"{target}/known") if keep_answers else None)


# A bucket of the stored grid holds about so many bytes of cells.
BUCKET_BYTES = 64 * 1024 * 1024


def _grid_name(path: str) -> str:
    return f"wayline_grid_{hashlib.md5(path.encode()).hexdigest()}"


def _grid_table(spark: SparkSession, path: str, columns: str, buckets: int) -> DataFrame:
    """The bucketed grid under a path, entered in this session's catalog."""
    name = _grid_name(path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
        f" CLUSTERED BY (_bits, _cell) SORTED BY (_bits, _cell) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def store_grid(cells: DataFrame, target: str, disjoint: bool = True, buckets: int | None = None) -> DataFrame:
    """Write grid cells bucketed and sorted by (width, cell), with their profile.

    Lookups of large tables join on these two columns, so the cells are read in place and only
    the addresses move. One bucket per :data:`BUCKET_BYTES`, but no fewer than shuffle partitions.
    """
    spark = cells.sparkSession
    profile = grid_profile(cells).collect()
    if buckets is None:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(least, -(-sum(r["size"] for r in profile) // BUCKET_BYTES))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema.fields)
    stated = spark.createDataFrame(
        [(r["_bits"], r.n, r["size"], buckets, columns, disjoint) for r in profile] or [(None, 0, 0, buckets, columns, disjoint)],
        "_bits int, n bigint, size bigint, buckets int, columns string, disjoint boolean",
    )
    spark.sql(f"DROP TABLE IF EXISTS {_grid_name(f'{target}/grid')}")
    table = _grid_table(spark, f"{target}/grid", columns, buckets)
    # One task per bucket: the shuffle's hash is the bucket's.
    cells.repartition(buckets, "_bits", "_cell").sortWithinPartitions("_bits", "_cell").select(*table.columns).write.mode(
        "overwrite"
    ).insertInto(_grid_name(f"{target}/grid"))
    _stored(stated, f"{target}/profile")
    return table


def build_ip_ranges(spark: SparkSession, source: str, target: str, attributes: tuple[str, ...] = ATTRIBUTES) -> DataFrame:
    """Address ranges from the gzip CSV: one row per range end, and the lookup grids of both modes.

    ``disjoint`` tells whether no two ranges overlap; if any do, the grid holds them cut. A gzip file is read by one task per
    file; what follows is spread by the sort.
    """
    rows = _stored(with_row_ids(read_ip_ranges(spark, source)), f"{target}/rows")
    merged = _stored(ip_range_table(rows, attributes), f"{target}/merged")
    disjoint = overlapping_ranges(merged).isEmpty()
    ranges = _stored(merged.withColumn("disjoint", F.lit(disjoint)), f"{target}/ranges")
    for mode in ("inclusive", "compat"):
        cells = grid_cells(ranges, (*attributes, "location", "representative_point"), mode, disjoint)
        store_grid(cells, f"{target}/{mode}", disjoint)
    return ranges


def open_grid(spark: SparkSession, target: str, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> RangeTable:
    """A grid stored by :func:`store_grid`, with its measured profile."""
    stated = spark.read.parquet(f"{target}/profile").collect()  # at most nine rows
    table = _grid_table(spark, f"{target}/grid", stated[0]["columns"], stated[0].buckets)
    columns = tuple(c for c in table.columns if not c.startswith("_"))
    profile = {r["_bits"]: (r.n, r["size"]) for r in stated if r["_bits"] is not None}
    return RangeTable(table, columns, profile, max_rows, max_bytes, stated[0].disjoint)


def open_ip_ranges(
    spark: SparkSession, target: str, mode: str = "inclusive", max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> RangeTable:
    """Address ranges built earlier; nothing is measured or computed again."""
    return open_grid(spark, f"{target}/{mode}", max_rows, max_bytes)


@dataclass(frozen=True)
class RelayBuild:
    """A relay table, what its lists held, and the exits the server list lacks."""

    relays: DataFrame
    exit_counts: dict[str, int]
    server_counts: dict[str, int]
    missing_servers: DataFrame


def load_relays(spark: SparkSession, exit_list: str, server_list: str, target: str) -> RelayBuild:
    """Relay flags from the exit and server address lists, with a report.

    Lines that are no address are counted while the table is written; exits missing from the
    server list are read off the table.
    """
    counts = Observation(), Observation()
    exits, servers = (address_set(scan_lines(spark, p), c) for p, c in zip((exit_list, server_list), counts))
    relays = _stored(relay_table(exits, servers), target)
    missing = relays.where(F.col("is_exit") & ~F.col("is_server")).select("ip_int")
    return RelayBuild(relays, counts[0].get, counts[1].get, missing)


def build_relays(spark: SparkSession, exit_list: str, server_list: str, target: str) -> DataFrame:
    """Relay flags alone; see :func:`load_relays` for what the lists held."""
    return load_relays(spark, exit_list, server_list, target).relays
