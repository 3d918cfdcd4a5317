import bisect
import random

import pytest
from conftest import no_nested_loops_or_python, plan_of
from pyspark.sql import functions as F

from wayline.operators import ranges as R
from wayline.plans.tables import open_grid, store_grid
from wayline.sources.tables import IP_RANGE_COLUMNS

COLUMNS = ("name",)


def table(spark, ranges, **options):
    df = spark.createDataFrame(ranges, "ip_from bigint, ip_to bigint, name string")
    return R.prepare_ranges(df, COLUMNS, **options)


def find(spark, addresses, prepared, **options):
    df = R.lookup_ip(spark.createDataFrame([(a,) for a in addresses], "ip bigint"), "ip", prepared, int_ip=True, **options)
    return df, {r.ip: r.geo_name for r in df.collect()}


def random_ranges(seed, n=300):
    """Disjoint ranges of all sizes, with gaps and neighbours."""
    rng = random.Random(seed)
    out, at = [], 0
    while len(out) < n and at < 2**32:
        size = rng.choice([1, 2, 16, 17, 255, 256, 5000, 70000, 2**20, 2**24 + 3, 2**26])
        if at + size > 2**32:
            break
        out.append((at, at + size - 1, f"r{len(out)}"))
        at += size + rng.choice([0, 0, 1, 100])
    return out


def probes(ranges, seed):
    rng = random.Random(seed)
    edges = [e + d for lo, hi, _ in ranges for e in (lo, hi) for d in (-1, 0, 1)]
    return sorted({a for a in edges + [rng.randrange(2**32) for _ in range(500)] if 0 <= a < 2**32})


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_inclusive_lookup(spark, max_rows):
    ranges = random_ranges(1)
    df, got = find(spark, probes(ranges, 2), table(spark, ranges, max_rows=max_rows))
    assert got == {a: next((n for lo, hi, n in ranges if lo <= a <= hi), None) for a in got}
    no_nested_loops_or_python(df)


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_compat_lookup_is_bisect_right(spark, max_rows):
    ranges = random_ranges(3)
    ends = [hi for _, hi, _ in ranges]
    _, got = find(spark, probes(ranges, 4), table(spark, ranges, mode="compat", max_rows=max_rows))
    for a, name in got.items():
        i = bisect.bisect_right(ends, a)
        assert name == (ranges[i][2] if i < len(ranges) else None), a


def test_overlapping_ranges_take_the_lowest_end(spark):
    ranges = [(0, 2**32 - 1, "all"), (100, 200, "a"), (150, 300, "b"), (2**31, 2**31 + 70000, "c")]
    df = spark.createDataFrame(ranges, "ip_from bigint, ip_to bigint, name string")
    assert not R.overlapping_ranges(df).isEmpty()
    _, got = find(spark, [0, 100, 200, 201, 300, 301, 2**31, 2**32 - 1], table(spark, ranges, disjoint=False))
    assert list(got.values()) == ["all", "a", "a", "b", "b", "all", "c", "all"]


@pytest.mark.parametrize("seed, max_rows", [(0, 10**6), (1, 0), (2, 10**6), (3, 0)])
def test_crossing_ranges_are_flattened(spark, seed, max_rows):
    """Ranges of all sizes that nest, cross, repeat and span many blocks, against a scan of them all."""
    rng = random.Random(seed)
    spread = [2**32, 2**20, 2**17, 400][seed]
    ranges = []
    for i in range(250):
        lo = rng.randrange(spread)
        size = rng.choice([1, 2, 50, 5000, 65536, 70000, 2**18, 2**22, 2**27, 2**31])
        ranges.append((lo, min(lo + size, 2**32) - 1, f"r{i}"))
    ranges += [(0, 2**32 - 1, "all"), (7, 3, "empty"), (65536, 131071, "block"), (65536, 131071, "block again")]
    df = spark.createDataFrame(ranges, "ip_from bigint, ip_to bigint, name string")
    flat = R.flattened(df, COLUMNS)
    assert R.overlapping_ranges(flat.select("ip_from", "ip_to")).isEmpty()
    found, got = find(spark, probes(ranges[:120], seed), table(spark, ranges, max_rows=max_rows))
    for a, name in got.items():
        assert name == min((hi, lo, n) for lo, hi, n in ranges if lo <= a <= hi)[2]
    no_nested_loops_or_python(found)


def test_a_hot_block_stays_bounded(spark):
    """A hundred thousand ranges that begin in one block: few marks reach its sweep."""
    ids = spark.range(100_000)
    df = ids.select((F.col("id") % 50).alias("ip_from"), (F.col("id") + 2**30).alias("ip_to"), F.col("id").cast("string").alias("name"))
    flat = R.flattened(df, COLUMNS)
    assert flat.where("ip_from <= 49").select("name").collect() == [("0",)]
    assert flat.where("ip_from > 49 and ip_to < 1073741824").select("name").distinct().collect() == [("0",)]
    assert flat.agg(F.max("ip_to")).first()[0] == 2**30 + 99_999


def test_stored_grid_is_read_in_place(spark, tmp_path):
    ranges = random_ranges(9, 200)
    df = spark.createDataFrame(ranges, "ip_from bigint, ip_to bigint, name string")
    store_grid(R.grid_cells(df, COLUMNS, "inclusive", True), str(tmp_path / "grid"))
    prepared = open_grid(spark, str(tmp_path / "grid"), max_rows=0)
    found, got = find(spark, probes(ranges, 10), prepared)
    assert got == {a: next((n for lo, hi, n in ranges if lo <= a <= hi), None) for a in got}
    # The cells of short ranges are scanned once, and nothing is exchanged between scan and join.
    fine = [b for b in prepared.bits if b not in prepared.broadcast_bits()]
    hits = R._distinct_hits(spark.createDataFrame([(1,)], "_ip bigint"), prepared, "_ip", fine)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for a table that is really large
    try:
        plan = plan_of(hits)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan") == 1 and "Bucketed: true" in plan
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    depth = lines[scan].index("FileScan")
    above = []
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :|+-*("))
        if at < depth:
            above.append(line)
            depth = at
        if "Join" in line:
            break
    assert above and not any("Exchange" in line for line in above)


def test_stream_takes_large_ranges(spark, tmp_path):
    """The same stream over the same ranges, small or large or overlapping: the same rows as in batch."""
    ranges = [*random_ranges(11, 80), (0, 2**32 - 1, "rest")]
    addresses = probes(ranges[:40], 12)[:400]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(map(str, addresses)) + "\n")
    results = []
    for max_rows in (10**6, 0):
        prepared = table(spark, ranges, max_rows=max_rows)
        lines = spark.readStream.text(str(tmp_path / "in")).withColumnRenamed("value", "ip")
        found = R.lookup_ip(lines, "ip", prepared, int_ip=True)
        out = str(tmp_path / f"out{max_rows}")
        found.writeStream.format("parquet").option("checkpointLocation", out + "_s").trigger(availableNow=True).start(out).awaitTermination()
        results.append(sorted((int(r.ip), r.geo_name) for r in spark.read.parquet(out).collect()))
    expected = [(a, min((hi, lo, n) for lo, hi, n in ranges if lo <= a <= hi)[2]) for a in addresses]
    assert results == [expected, expected]


def test_disjoint_ranges_do_not_overlap(spark):
    df = spark.createDataFrame(random_ranges(5), "ip_from bigint, ip_to bigint, name string")
    assert R.overlapping_ranges(df).isEmpty()
    assert not R.overlapping_ranges(df.union(spark.createDataFrame([(7, 3, "x")], df.schema))).isEmpty()


def test_grid_bounds(spark):
    cells = R.range_cells(spark.createDataFrame(random_ranges(6, 500), "ip_from bigint, ip_to bigint, name string"))
    assert cells.groupBy("_lo").count().agg(F.max("count")).first()[0] <= 2
    assert cells.groupBy("_bits", "_cell").count().agg(F.max("count")).first()[0] <= 18


def test_rows_stay_and_bad_addresses_get_nulls(spark):
    prepared = table(spark, [(0, 2**32 - 1, "all")])
    df = spark.createDataFrame([("1.2.3.4",), ("x",), (None,), ("1.2.3.4",)], "ip string")
    assert sorted(str(r.geo_name) for r in R.lookup_ip(df, "ip", prepared).collect()) == ["None", "None", "all", "all"]


def test_empty_table(spark):
    _, got = find(spark, [1, 2], table(spark, [(5, 4, "none")]))
    assert got == {1: None, 2: None}


def test_known_address(spark):
    row = (134744064, 134744319, "US", "UNITED STATES", "CALIFORNIA", "MOUNTAIN VIEW", 37.405992, -122.078515, "94043", 0)
    low = (0, 134744063, "-", "-", "-", "-", 0.0, 0.0, "-", 1)
    raw = spark.createDataFrame(
        [row, low],
        ", ".join(f"{c} {t}" for c, t in zip(IP_RANGE_COLUMNS, ["bigint"] * 2 + ["string"] * 4 + ["double"] * 2 + ["string"]))
        + ", row_id bigint",
    )
    prepared = R.prepare_ranges(R.ip_range_table(raw))
    for df, int_ip in ((spark.createDataFrame([("8.8.8.8",)], "ip string"), False), (spark.createDataFrame([(134744072,)], "ip bigint"), True)):
        got = R.lookup_ip(df, "ip", prepared, int_ip=int_ip).drop("ip").first().asDict()
        assert got == {
            "geo_country_code": "US", "geo_country_name": "UNITED STATES", "geo_location": "37.405992,-122.078515",
            "geo_place_name": "MOUNTAIN VIEW", "geo_region_name": "CALIFORNIA", "geo_zip_code": "94043",
            "geo_representative_point": "37.405992,-122.078515",
        }


def test_networks(spark):
    nets = spark.createDataFrame([("0.0.0.0/0",), ("10.0.0.0/8",), ("10.1.0.0/16",), ("10.1.1.1/16",), ("x",), ("1.2.3.4/33",)], "cidr string")
    df = spark.createDataFrame([("10.1.2.3",), ("11.0.0.1",), ("bad",)], "ip string")
    got = sorted((r.ip, r.cidr) for r in R.join_networks(df, "ip", nets).collect())
    assert got == [("10.1.2.3", "0.0.0.0/0"), ("10.1.2.3", "10.0.0.0/8"), ("10.1.2.3", "10.1.0.0/16"), ("11.0.0.1", "0.0.0.0/0")]


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_overlap_is_measured(spark, max_rows):
    """Overlapping ranges give one row per address, whatever the caller knew."""
    prepared = table(spark, [(0, 100, "a"), (50, 200, "b")], max_rows=max_rows)
    df, got = find(spark, [60, 150, 201], prepared)
    assert not prepared.disjoint and df.count() == 3
    assert got == {60: "a", 150: "b", 201: None}
