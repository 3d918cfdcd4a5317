"""Address-range lookups as equi-joins on a size-adapted grid.

A bare BETWEEN join plans as a nested loop. Here every range is put on a grid whose
cells are at least as wide as the range, so it touches at most two cells, and an
address needs one equal-key probe per grid width in use. Disjoint ranges give two
bounds that hold for any data:

* ranges longer than 2^16 addresses: at most 65,536 exist, so they are broadcast;
* a cell of a narrower grid holds at most 65,536 addresses and 18 ranges.

Overlapping ranges are cut into disjoint ones beforehand (:func:`flattened`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayline.functions.ip import _right, ip_to_int, network_address, prefix_length, prefix_mask
from wayline.operators.first_match import _merged, first_match
from wayline.operators.sizing import MAX_BYTES, MAX_ROWS, hinted, is_small, row_bytes
from wayline.scratch import stored

GRID_BITS = tuple(range(0, 33, 4))
COARSE_BITS = 20
# Overlaps are resolved in blocks of 65,536 addresses.
_BLOCK_BITS = 16

# Output attributes of the address-range table.
ATTRIBUTES = ("country_code", "country_name", "place_name", "region_name", "zip_code")


def ip_range_table(raw: DataFrame, attributes: tuple[str, ...] = ATTRIBUTES) -> DataFrame:
    """One row per ``ip_to``: first row's attributes plus location and representative point."""
    return first_match(raw, ["ip_to"], ("ip_from", *attributes))


def with_previous_end(ranges: DataFrame, lo: str = "ip_from", hi: str = "ip_to") -> DataFrame:
    """Add ``previous_end``: the next lower range end, null for the lowest.

    Ends are ranked within cells of 65,536 addresses. What crosses cells is one maximum
    per cell, at most 65,536 rows for the whole address space.
    """
    cell = F.shiftright(F.col(hi), 16)
    cells = ranges.withColumn("_cell", cell)
    inside = cells.withColumn("_lag", F.lag(hi).over(Window.partitionBy("_cell").orderBy(hi)))
    ends = ranges.groupBy(cell.alias("_cell")).agg(F.max(hi).alias("_end"))
    before = ends.select(
        "_cell",
        F.max("_end").over(Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
    )
    return (
        inside.join(F.broadcast(before), "_cell", "left")
        .withColumn("previous_end", F.coalesce("_lag", "_before"))
        .select(*ranges.columns, "previous_end")
    )


def overlapping_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges that start at or before the end of the one below, or end before they start."""
    bounds = with_previous_end(ranges)
    return bounds.where((F.col("ip_from") <= F.col("previous_end")) | (F.col("ip_to") < F.col("ip_from")))


def next_end_intervals(ranges: DataFrame) -> DataFrame:
    """Intervals of "the first range whose end lies above the address".

    Starts are ignored, an address equal to an end belongs to the next range, gaps
    belong to the range above, and addresses from the last end on have no range.
    """
    bounds = with_previous_end(ranges)
    start = F.coalesce(F.col("previous_end"), F.lit(0).cast("bigint"))
    return (
        bounds.withColumn("ip_from", start).withColumn("ip_to", F.col("ip_to") - 1)
        .where("ip_to >= ip_from").drop("previous_end")
    )


def _spanning(ranges: DataFrame) -> DataFrame:
    """``_block, _end``: the lowest end of the ranges that begin before a block and end after it.

    The blocks under a range are cut into at most 32 aligned runs of a power of two. A run keeps
    its lowest end, and a block takes the lowest of the 17 runs that hold it, so what is joined
    is bounded by the number of blocks.
    """
    first, last = F.shiftright("_lo", _BLOCK_BITS) + 1, F.shiftright("_hi", _BLOCK_BITS) - 1
    runs = []
    for k in range(32 - _BLOCK_BITS + 1):
        left, right = F.shiftright(first + ((1 << k) - 1), k), F.shiftright(last + 1, k)
        for taken, number in ((left % 2 == 1, left), (right % 2 == 1, right - 1)):
            runs.append(F.when((left < right) & taken, F.struct(F.lit(k).alias("_k"), number.alias("_run"))))
    covered = ranges.where(first <= last).select("_hi", F.explode(F.array_compact(F.array(*runs))).alias("_r"))
    lowest = covered.groupBy("_r._k", "_r._run").agg(F.min("_hi").alias("_end"))
    blocks = ranges.sparkSession.range(1 << (32 - _BLOCK_BITS)).withColumnRenamed("id", "_block")
    above = F.array(
        *[F.struct(F.lit(k).alias("_k"), F.shiftright("_block", k).alias("_run")) for k in range(32 - _BLOCK_BITS + 1)]
    )
    held = blocks.select("_block", F.explode(above).alias("_r")).select("_block", "_r.*")
    return held.join(lowest, ["_k", "_run"]).groupBy("_block").agg(F.min("_end").alias("_end"))


def flattened(ranges: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Disjoint ranges in which an address has the attributes of the range with the lowest end
    among those that hold it (of equal ends, the lowest start).

    A distributed sweep: a range is known to the blocks of 65,536 addresses that hold one of its ends; a block
    also gets the one range that wins among those spanning it. That leaves at most two ranges
    per address of a block, whatever the table holds, and each block is swept on its own.
    """
    least = F.min(F.struct("ip_from", *columns))
    best = ranges.where("ip_to >= ip_from").groupBy(F.col("ip_to").alias("_end")).agg(least.alias("_best"))
    known = best.select(F.col("_best.ip_from").alias("_lo"), F.col("_end").alias("_hi"))
    block = [F.shiftright(c, _BLOCK_BITS) for c in ("_lo", "_hi")]
    begins = (
        known.where(block[0] < block[1]).groupBy(block[0].alias("_block"), F.col("_lo").alias("_start"))
        .agg(F.min("_hi").alias("_end"))
    )
    ends = known.select(
        block[1].alias("_block"), F.greatest(F.col("_lo"), F.shiftleft(block[1], _BLOCK_BITS)).alias("_start"),
        F.col("_hi").alias("_end"),
    )
    spans = _spanning(known).select("_block", F.shiftleft("_block", _BLOCK_BITS).alias("_start"), "_end")
    marks = begins.unionByName(ends).unionByName(spans).repartition("_block").sortWithinPartitions("_block")
    swept = marks.mapInArrow(_sweep(_BLOCK_BITS), "ip_from bigint, ip_to bigint, _end bigint")
    return swept.join(best, "_end").select("ip_from", "ip_to", *[F.col("_best").getField(c).alias(c) for c in columns])


def _sweep(bits: int):
    """Partition function over marks sorted by block; it refers to nothing outside, so that
    workers need not import this package."""

    def sweep(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def segments(starts, stops, ends):
            # Stretches between neighbouring marks, painted from the highest end to the lowest.
            edges = np.unique(np.concatenate([starts, stops + 1]))
            first, last = np.searchsorted(edges, starts), np.searchsorted(edges, stops + 1)
            owner = np.full(len(edges), -1, dtype=np.int64)
            for k in np.lexsort((starts, ends))[::-1].tolist():
                owner[first[k] : last[k]] = ends[k]
            fresh = np.flatnonzero(np.diff(owner, prepend=-1))
            taken = owner[fresh] >= 0
            return edges[fresh][taken], np.append(edges[fresh[1:]], 0)[taken] - 1, owner[fresh][taken]

        def swept(marks):
            block, starts, ends = marks
            stops = np.minimum(ends, ((block + 1) << bits) - 1)
            cuts = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(block))
            alone = cuts[:-1][np.diff(cuts) == 1]
            parts = [(starts[alone], stops[alone], ends[alone])]
            for k in np.flatnonzero(np.diff(cuts) > 1).tolist():
                a, b = cuts[k], cuts[k + 1]
                parts.append(segments(starts[a:b], stops[a:b], ends[a:b]))
            columns = [pa.array(np.concatenate(c)) for c in zip(*parts)]
            return pa.RecordBatch.from_arrays(columns, names=["ip_from", "ip_to", "_end"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("_block", "_start", "_end")]
            if held is not None:
                marks = [np.concatenate(pair) for pair in zip(held, marks)]
            # The last block may go on in the next batch.
            cut = int(np.searchsorted(marks[0], marks[0][-1]))
            if cut:
                yield swept([m[:cut] for m in marks])
            held = [m[cut:] for m in marks]
        if held is not None:
            yield swept(held)

    return sweep


def range_cells(ranges: DataFrame, lo: str = "ip_from", hi: str = "ip_to") -> DataFrame:
    """Put each range on the grid: ``_bits`` (width) and ``_cell``, at most two per range."""
    length = F.col(hi) - F.col(lo) + 1
    bits = F.lit(GRID_BITS[-1])
    for b in reversed(GRID_BITS[:-1]):
        bits = F.when(length <= (1 << b), F.lit(b)).otherwise(bits)
    payload = [c for c in ranges.columns if c not in (lo, hi)]
    sized = ranges.where(length >= 1).select(
        F.col(lo).alias("_lo"), F.col(hi).alias("_hi"), *payload, bits.alias("_bits")
    )
    touched = F.sequence(_right(F.col("_lo"), F.col("_bits")), _right(F.col("_hi"), F.col("_bits")))
    return sized.withColumn("_cell", F.explode(touched))


@dataclass(frozen=True)
class RangeTable:
    """Disjoint ranges on the grid, with what was measured about them: rows and bytes by width."""

    cells: DataFrame
    columns: tuple[str, ...]
    profile: dict[int, tuple[int, int]]
    max_rows: int = MAX_ROWS
    max_bytes: int = MAX_BYTES
    disjoint: bool = True  # Whether the ranges were so before they were cut; no lookup depends on it.
    bits: tuple[int, ...] = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "bits", tuple(sorted(self.profile)))

    def _fits(self, bits: list[int], max_rows: int) -> bool:
        rows, size = (sum(self.profile[b][i] for b in bits) for i in (0, 1))
        return rows <= max_rows and size <= self.max_bytes

    @property
    def small(self) -> bool:
        return self._fits(list(self.bits), self.max_rows)

    def broadcast_bits(self) -> list[int]:
        """Widths to join by broadcast: all of a small table; of a large one those of long ranges,
        of which there are at most 65,536, if their text measures small too."""
        if self.small:
            return list(self.bits)
        long = [b for b in self.bits if b >= COARSE_BITS]
        return long if self._fits(long, 2 * 65_536) else []


def grid_profile(cells: DataFrame) -> DataFrame:
    """Rows and bytes by grid width: at most nine rows."""
    return cells.groupBy("_bits").agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(cells)).alias("size"))


def grid_cells(ranges: DataFrame, columns: tuple[str, ...], mode: str, disjoint: bool) -> DataFrame:
    """Ranges on the grid, cut where they overlap."""
    if mode not in ("inclusive", "compat"):
        raise ValueError(f"unknown range mode {mode!r}")
    if mode == "compat":
        chosen = next_end_intervals(ranges)
    else:
        chosen = ranges if disjoint else stored(flattened(ranges, columns), "flat_ranges")
    return range_cells(chosen.select("ip_from", "ip_to", *columns))


def prepare_ranges(
    ranges: DataFrame,
    columns: tuple[str, ...] = (*ATTRIBUTES, "location", "representative_point"),
    mode: str = "inclusive",
    disjoint: bool | None = None,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
) -> RangeTable:
    """Measure a range table and choose how lookups will join it.

    ``inclusive`` ranges hold both ends; ``compat`` uses :func:`next_end_intervals`.
    Of overlapping ranges the containing one with the lowest end answers; whether any overlap
    is measured unless ``disjoint`` tells. For a table that
    serves many runs, build the grid once (:func:`wayline.plans.tables.build_ip_ranges`).
    """
    if disjoint is None:
        disjoint = mode == "compat" or overlapping_ranges(ranges).isEmpty()
    cells = grid_cells(ranges, columns, mode, disjoint)
    profile = {r["_bits"]: (r.n, r["size"]) for r in grid_profile(cells).collect()}
    return RangeTable(cells, tuple(columns), profile, max_rows, max_bytes, disjoint)


def _address(column: str, int_ip: bool) -> Column:
    value = F.col(f"`{column}`")
    return value.try_cast("bigint") if int_ip else ip_to_int(value)


def _answer(table: RangeTable) -> Column:
    return F.struct(*table.columns)


def _cell_join(probe: DataFrame, table: RangeTable, ip: str, bits: int, small: bool) -> DataFrame:
    """Left join of one grid width; the ranges are disjoint."""
    side = table.cells.where(F.col("_bits") == bits).select(
        F.col("_cell").alias(f"_cell_{bits}"), F.col("_lo").alias(f"_lo_{bits}"),
        F.col("_hi").alias(f"_hi_{bits}"), _answer(table).alias(f"_range_{bits}"),
    )
    inside = (F.shiftright(F.col(ip), bits) == F.col(f"_cell_{bits}")) & F.col(ip).between(
        F.col(f"_lo_{bits}"), F.col(f"_hi_{bits}")
    )
    return probe.join(hinted(side, small), inside, "left")


def _distinct_hits(probe: DataFrame, table: RangeTable, ip: str, bits: list[int]) -> DataFrame:
    """Distinct addresses joined to their ranges by shuffle on (width, cell); a stored grid is
    bucketed by these and stays where it is. ``_asked_ip`` names no column a caller keeps a parsed address in."""
    addresses = probe.where(F.col(ip).isNotNull()).select(F.col(ip).alias("_asked_ip")).distinct()
    keys = F.array(
        *[F.struct(F.lit(b).alias("_bits"), F.shiftright(F.col("_asked_ip"), b).alias("_cell")) for b in bits]
    )
    exploded = addresses.select("_asked_ip", F.explode(keys).alias("_key")).select("_asked_ip", "_key.*")
    joined = exploded.join(table.cells, ["_bits", "_cell"]).where(F.col("_asked_ip").between(F.col("_lo"), F.col("_hi")))
    return joined.select("_asked_ip", _answer(table).alias("_range_shuffled"))


def lookup_ip(
    probe: DataFrame,
    ip: str,
    table: RangeTable,
    prefix: str = "geo_",
    int_ip: bool = False,
    address: str | None = None,
) -> DataFrame:
    """Left lookup of an address column; unparsable or null addresses get nulls.
    ``address`` names a column that already holds the parsed value.

    A small table joins by broadcast, without moving the probe. Of a large one only the long
    ranges are broadcast; the rest is resolved for the distinct addresses and joined back by
    address. A stream takes them by one shuffled join per width instead, since it cannot be
    made distinct: the same rows, whatever the size of the table.
    """
    value = F.col(address) if address else _address(ip, int_ip)
    keyed = probe.withColumn("_ip", value)
    direct = table.broadcast_bits()
    shuffled = [b for b in table.bits if b not in direct]
    found = []
    for bits in direct:
        keyed = _cell_join(keyed, table, "_ip", bits, True)
        found.append(F.col(f"_range_{bits}"))
    if shuffled and probe.isStreaming:
        for bits in shuffled:
            keyed = _cell_join(keyed, table, "_ip", bits, False)
            found.append(F.col(f"_range_{bits}"))
    elif shuffled:
        hits = _distinct_hits(probe.select(value.alias("_ip")), table, "_ip", shuffled)
        keyed = keyed.join(hits, F.col("_ip") == F.col("_asked_ip"), "left")
        found.append(F.col("_range_shuffled"))
    if not found:
        found = [F.lit(None).cast(table.cells.select(_answer(table).alias("r")).schema["r"].dataType)]
    resolved = keyed.withColumn("_range", F.coalesce(*found))
    flat = resolved.select(
        *[F.col(f"`{c}`") for c in probe.columns],
        *[F.col("_range").getField(c).alias(f"_v_{c}") for c in table.columns],
        F.col("_range").isNotNull().alias("_hit"),
    )
    return flat.select(*_merged(probe.columns, table.columns, prefix))


def join_networks(probe: DataFrame, ip: str, networks: DataFrame, cidr: str = "cidr", int_ip: bool = False) -> DataFrame:
    """All (row, network) pairs where the network contains the address.

    One equal-key join on (prefix length, masked address), for the prefix lengths that
    occur. Networks with host bits set contain nothing.
    """
    length, start = prefix_length(F.col(cidr)), network_address(F.col(cidr))
    nets = networks.withColumn("_length", length).withColumn("_net", start)
    nets = nets.where(F.col("_net").bitwiseAND(prefix_mask(F.col("_length"))) == F.col("_net"))
    lengths = sorted(r[0] for r in nets.select("_length").distinct().collect())  # at most 33 values
    keys = F.array(
        *[
            F.struct(
                F.lit(n).alias("_length"),
                F.col("_ip").bitwiseAND(F.lit((4294967295 << (32 - n)) & 4294967295)).alias("_net"),
            )
            for n in lengths
        ]
    ) if lengths else F.array().cast("array<struct<_length:int,_net:bigint>>")
    exploded = probe.withColumn("_ip", _address(ip, int_ip)).withColumn("_key", F.explode(keys))
    exploded = exploded.select(*probe.columns, "_key.*")
    joined = exploded.join(hinted(nets, is_small(networks)), ["_length", "_net"])
    return joined.drop("_length", "_net")
