import random

import pytest
from conftest import no_nested_loops_or_python, plan_of
from pyspark.sql import functions as F

from wayline.operators.first_match import first_match
from wayline.operators.lookup import COUNTRY, IP_RANGE_PLACES, LookupSpec, key_answers, lookup, lookup_any
from wayline.operators.sizing import is_small


@pytest.fixture
def countries(spark):
    rows = [(40.463667, -3.74922, "ES", "SPAIN", 0), (42.546245, 1.5, "AD", "ANDORRA", 1), (-22.5, 17.0, "NA", "NAMIBIA", 2)]
    return spark.createDataFrame(rows, "latitude double, longitude double, country_code string, country_name string, row_id bigint")


SPAIN = ("ES", "SPAIN", "40.463667,-3.74922", "40.463667,-3.74922")


def geo(df):
    return [tuple(r) for r in df.select("geo_country_code", "geo_country_name", "geo_location", "geo_representative_point").collect()]


def test_country_by_code_or_name(spark, countries):
    probe = spark.createDataFrame([("es", "Spain")], "code string, name string")
    assert geo(lookup(probe, countries, COUNTRY, {"country_code": "code"})) == [SPAIN]
    assert geo(lookup(probe, countries, COUNTRY, {"country_name": "name"})) == [SPAIN]
    assert geo(lookup(probe, countries, COUNTRY, {"country_code": "code", "country_name": "name"})) == [SPAIN]
    potato = spark.createDataFrame([("POTATO",)], "name string")
    assert geo(lookup(potato, countries, COUNTRY, {"country_name": "name"})) == [(None,) * 4]
    for keys in ({}, {"planet": "code"}):
        with pytest.raises(ValueError):
            lookup(probe, countries, COUNTRY, keys)


def test_only_given_keys_take_part(spark, countries):
    probe = spark.createDataFrame(
        [(0, "ES", None), (1, None, "spain"), (2, "ES", "ANDORRA"), (3, None, None), (4, "", "SPAIN")], "n int, c string, m string"
    )
    df = lookup(probe, countries, COUNTRY, {"country_code": "c", "country_name": "m"}, optional_keys=True)
    hits = {r.n: r.geo_country_code for r in df.collect()}
    assert hits == {0: "ES", 1: "ES", 2: None, 3: None, 4: None}
    no_nested_loops_or_python(df)


def test_same_named_column_is_kept_on_a_miss(spark, countries):
    probe = spark.createDataFrame([("ES", "mine"), ("XX", "mine")], "c string, geo_location string")
    df = lookup(probe, countries, COUNTRY, {"country_code": "c"})
    assert {r.c: r.geo_location for r in df.collect()} == {"ES": "40.463667,-3.74922", "XX": "mine"}
    assert df.columns.count("geo_location") == 1


def test_large_table_joins_without_broadcast_hint(spark, countries):
    probe = spark.createDataFrame([("ES",)], "c string")
    assert "BroadcastHashJoin" in plan_of(lookup(probe, countries, COUNTRY, {"country_code": "c"}, small=True))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = lookup(probe, countries, COUNTRY, {"country_code": "c"}, small=False)
        assert "SortMergeJoin" in plan_of(df) and "Broadcast" not in plan_of(df)
        assert geo(df) == [SPAIN]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_size_check(spark):
    df = spark.range(100).select(F.col("id"), F.lit("x" * 1000).alias("t"))
    assert is_small(df) and not is_small(df, max_rows=99) and not is_small(df, max_bytes=100_000)
    assert not is_small(df, rows_per_row=4, max_rows=399)


def brute_answer(rows):
    rows = sorted(rows, key=lambda r: r["row_id"])
    lat = sum(r["latitude"] for r in rows) / len(rows)
    lon = sum(r["longitude"] for r in rows) / len(rows)
    near = min(rows, key=lambda r: ((r["latitude"] - lat) ** 2 + (r["longitude"] - lon) ** 2, r["row_id"]))
    return rows[0]["name"], f"{rows[0]['latitude']},{rows[0]['longitude']}", f"{near['latitude']},{near['longitude']}"


@pytest.fixture
def table(spark):
    rng = random.Random(1)
    rows = [
        # A third of the rows share key a; quarter degrees are exact in binary.
        dict(k="a" if rng.random() < 0.34 else rng.choice("bcdefgh"), m=rng.choice("xyz"), name=f"n{i}",
             latitude=rng.randint(-360, 360) / 4, longitude=rng.randint(-720, 720) / 4, row_id=i)
        for i in range(600)
    ]
    return rows, spark.createDataFrame(rows, "k string, m string, name string, latitude double, longitude double, row_id bigint")


@pytest.mark.parametrize("with_source", [False, True])
def test_first_row_and_nearest_to_centroid(table, with_source):
    rows, df = table
    got = {r.k: (r.name, r.location, r.representative_point)
           for r in first_match(df.repartition(5), ["k"], ["name"], source=df if with_source else None).collect()}
    assert got == {k: brute_answer([r for r in rows if r["k"] == k]) for k in {r["k"] for r in rows}}


def test_missing_points(spark):
    df = spark.createDataFrame(
        [("a", None, 1.0, 0), ("a", 2.0, 2.0, 1), ("b", None, None, 2)], "k string, latitude double, longitude double, row_id bigint"
    )
    got = {r.k: (r.location, r.representative_point) for r in first_match(df, ["k"], []).collect()}
    assert got == {"a": (None, None), "b": (None, None)}


def test_any_key(spark, table):
    rows, df = table
    spec = LookupSpec(("k", "m"), ("name",))
    probes = [(i, k, m) for i, (k, m) in enumerate([("A", "X"), ("B", None), (None, "Y"), ("Q", "Z"), ("Q", "Q"), (None, None)])]
    upper = df.withColumn("k", F.upper("k")).withColumn("m", F.upper("m"))
    found = lookup_any(spark.createDataFrame(probes, "i int, a string, b string"), upper, spec, {"k": "a", "m": "b"})
    got = {r.i: (r.geo_name, r.geo_location, r.geo_representative_point) for r in found.collect()}
    for i, k, m in probes:
        match = [r for r in rows if r["k"].upper() == k or r["m"].upper() == m]
        assert got[i] == (brute_answer(match) if match else (None, None, None))


def test_key_subsets(table):
    rows, df = table
    answers = key_answers(df, LookupSpec(("k", "m"), ("name",)), ["k", "m"], every_subset=True).collect()
    keys = {("k", r["k"]) for r in rows} | {("m", r["m"]) for r in rows} | {(r["k"], r["m"]) for r in rows}
    assert len(answers) == len(keys)
    chosen = key_answers(df, LookupSpec(("k", "m"), ("name",)), ["k", "m"], every_subset=True, masks=[2]).collect()
    assert {r["_mask"] for r in chosen} == {2} and len(chosen) == len({r["m"] for r in rows})


def test_five_optional_keys(spark):
    rows = [("US", "STATES", "TEXAS", "AUSTIN", "1", 30.0, -97.0, 1), ("US", "STATES", "OHIO", "DAYTON", "2", 39.0, -84.0, 2)]
    table = spark.createDataFrame(rows, "country_code string, country_name string, region_name string, place_name string, zip_code string, "
                                  "latitude double, longitude double, row_id long")
    on = {k: k for k in IP_RANGE_PLACES.keys}
    schema = ", ".join(f"{k} string" for k in on)
    probes = [("us", "states", "ohio", "dayton", "2"), ("us", None, None, None, None), (None,) * 5, ("us", None, None, None, "3")]
    probe = spark.createDataFrame(probes, schema).select(*[F.col(k).alias(f"p_{k}") for k in on])
    found = lookup(probe, table, IP_RANGE_PLACES, {k: f"p_{k}" for k in on}, optional_keys=True)
    got = {tuple(r[:5]): r["geo_place_name"] for r in found.collect()}
    assert got == dict(zip(probes, ["DAYTON", "AUSTIN", None, None]))


def test_any_key_tells_null_from_text(spark):
    table = spark.createDataFrame([("\u0000", "X", 1.0, 2.0, 1)], "country_code string, country_name string, latitude double, longitude double, row_id long")
    probe = spark.createDataFrame([(None, "Y"), ("\u0000", "Y"), ("", "x"), (None, None)], "code string, name string")
    found = lookup_any(probe, table, COUNTRY, {"country_code": "code", "country_name": "name"})
    got = {(r.code, r.name): r.geo_country_name for r in found.collect()}
    assert got == {(None, "Y"): None, ("\u0000", "Y"): "X", ("", "x"): "X", (None, None): None}
