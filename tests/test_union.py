"""Lookups by any of several conditions, against listing their matches."""

import random

import pytest
from conftest import no_nested_loops_or_python
from pyspark.sql import functions as F

from wayline.operators import lookup as L
from wayline.operators import nearest, places as P, union_match
from wayline.operators.answers import AnswerStore
from wayline.sources.tables import PLACE_COLUMNS

SPEC = L.LookupSpec(("a", "b", "c"), ("name",), "lat", "lon", "id")


def answer(matches):
    """First row and the point nearest to the centroid, of rows (id, name, lat, lon)."""
    if not matches:
        return None, None, None
    matches = sorted(matches)
    first = matches[0]
    text = lambda r: None if r[2] is None or r[3] is None else f"{r[2]},{r[3]}"
    points = [r for r in matches if r[2] is not None and r[3] is not None]
    if len(points) < 2:
        return first[1], text(first), text(first)
    lat, lon = (sum(r[k] for r in points) / len(points) for k in (2, 3))
    near = min(points, key=lambda r: ((r[2] - lat) ** 2 + (r[3] - lon) ** 2, r[0]))
    return first[1], text(first), text(near)


def coordinates(rng):
    if rng.random() < 0.08:
        return None, rng.choice([None, 1.5])
    return rng.randrange(-720, 720) / 8, rng.randrange(-1440, 1440) / 8 if rng.random() < 0.95 else 512.0


def test_any_of_three_keys(spark):
    rng = random.Random(3)
    key = lambda n: rng.choice([None, *(f"K:{i}" for i in range(n))])
    table = [(i, f"n{i}", *coordinates(rng), key(4), key(9), key(40)) for i in range(600)]
    probes = [(j, key(6), key(10), key(50)) for j in range(300)] + [(900, None, None, None), (901, "K", ":0", "")]
    rows = spark.createDataFrame(table, "id bigint, name string, lat double, lon double, a string, b string, c string")
    probe = spark.createDataFrame(probes, "j bigint, x string, y string, z string").repartition(3)
    found = L.lookup_any(probe, rows, SPEC, {"a": "x", "b": "y", "c": "z"})
    no_nested_loops_or_python(found)
    got = {r.j: (r.geo_name, r.geo_location, r.geo_representative_point) for r in found.collect()}
    assert len(got) == len(probes)
    for j, *keys in probes:
        assert got[j] == answer([r[:4] for r in table if any(k is not None and k == v for k, v in zip(keys, r[4:]))]), j


def test_any_place_condition(spark):
    rng = random.Random(5)
    words = ["new", "old", "york", "port", "saint", "mount", "bay"]
    table = []
    for i in range(400):
        lat, lon = coordinates(rng)
        table.append((rng.choice("ABCD"), str(i), " ".join(rng.sample(words, rng.randint(1, 3))), rng.choice(words), lat, lon, i))
    schema = "country_code string, zip_code string, place_name string, admin_name1 string, latitude double, longitude double, row_id bigint"
    places = spark.createDataFrame(table, schema).withColumn("accuracy", F.lit(1.0))
    for c in PLACE_COLUMNS:
        if c not in places.columns:
            places = places.withColumn(c, F.lit(None).cast("string"))
    index = P.place_index(places)
    probes = [
        (j, rng.choice([None, " ".join(rng.sample(words, rng.randint(1, 2))), "nowhere", "?"]), rng.choice([None, *words]), rng.choice([None, *"ABCDE"]))
        for j in range(150)
    ]
    probe = spark.createDataFrame(probes, "j bigint, t string, r string, c string")
    found = P.lookup_place(probe, index, {"place_name": "t", "region_name": "r", "country_code": "c"}, "OR", "column")
    no_nested_loops_or_python(found)
    got = {r.j: (r.geo_zip_code, r.geo_location, r.geo_representative_point) for r in found.collect()}

    def holds(row, town, region, code):
        asked = [(town.split(), row[2].split())] if town and town != "?" else []
        asked += [([region], row[3].split())] if region else []
        asked += [([code.lower()], [row[0].lower()])] if code else []
        return any(set(want) <= set(have) for want, have in asked)

    for j, *keys in probes:
        matches = [(row[6], row[1], row[4], row[5]) for row in table if holds(row, *keys)]
        assert got[j] == answer(matches), (j, keys)


def test_subsets(spark):
    df = spark.createDataFrame([(["x", "y", "z"],), ([],)], "n array<string>").select(union_match.subsets(F.col("n")).alias("s"))
    three, none = [r.s for r in df.collect()]
    assert sorted(map(tuple, three)) == sorted([("x",), ("y",), ("z",), ("x", "y"), ("x", "z"), ("y", "z"), ("x", "y", "z")])
    assert [s for s in none if s] == []


@pytest.mark.parametrize("spread", [1.0, 180.0, 1e6])
def test_nearest_of_many_points(spark, spread):
    """Crowded, worldwide and out-of-range points, with ties."""
    rng = random.Random(int(spread))
    draw = lambda: round(rng.uniform(-0.5, 0.5) * spread * 4) / 4
    points = [(rng.choice("pq"), draw(), draw(), i) for i in range(3000)]
    asked = [(f"q{j}", draw(), draw(), rng.choice([["p"], ["q"], ["p", "q"]])) for j in range(60)]
    df = spark.createDataFrame(points, "_name string, latitude double, longitude double, _row bigint")
    q = spark.createDataFrame(asked, "_query string, _center_lat double, _center_lon double, _names array<string>")
    got = {r._query: tuple(r._near) for r in nearest.nearest_members(q, df).collect()}
    for name, lat, lon, names in asked:
        best = min(((p[1] - lat) * (p[1] - lat) + (p[2] - lon) * (p[2] - lon), p[3], p[1], p[2]) for p in points if p[0] in names)
        assert got[name] == best[2:]


def test_written_rows_grow_with_the_input(spark, monkeypatch):
    """Places and queries grow together, half of the places share a word: what is written stays in proportion."""
    written = []

    def counted(df, name, keep=P.stored):
        out = keep(df, name)
        written.append((name, out.count()))
        return out

    for module in (P, L, nearest):
        monkeypatch.setattr(module, "stored", counted)
    totals = []
    for n in (500, 2000, 8000):
        written.clear()
        i = F.col("id")
        table = spark.range(n).select(
            F.when(i % 2 == 0, "HOT").otherwise(F.concat(F.lit("C"), i % 50)).alias("country_code"),
            F.concat(F.lit("T"), F.floor(i / 4)).alias("place_name"), (i % 180 - 90.0).alias("latitude"),
            (i * 7 % 360 - 180.0).alias("longitude"), i.cast("string").alias("zip_code"), i.alias("row_id"),
            *[F.lit(None).cast("string").alias(c) for c in PLACE_COLUMNS if c.startswith("admin")], F.lit(1.0).alias("accuracy"),
        )
        probe = table.select("country_code", "place_name")
        index = P.place_index(table)
        P.lookup_place(probe, index, {"country_code": "country_code", "place_name": "place_name"}, "OR").count()
        spec = L.LookupSpec(("country_code", "place_name"), ("zip_code",))
        L.lookup_any(probe, table, spec, {"country_code": "country_code", "place_name": "place_name"}).count()
        totals.append(sum(rows for _, rows in written))
    assert totals[2] < 4.4 * totals[1] < 4.4 * 4.4 * totals[0]
    assert totals[2] < 40 * 8000  # Listing the matches would take half of 8000 * 2000 rows.


def test_known_queries_are_not_matched_again(spark, tmp_path):
    table = spark.createDataFrame(
        [("ES", "M", "MADRID", 1.0, 2.0, 0), ("ES", "B", "BILBAO", 3.0, 4.0, 1)],
        "country_code string, zip_code string, place_name string, latitude double, longitude double, row_id bigint",
    )
    for c in PLACE_COLUMNS:
        if c not in table.columns:
            table = table.withColumn(c, F.lit(None).cast("string"))
    plain = P.place_index(table)
    store = AnswerStore(spark, str(tmp_path / "known"))
    computed = []

    class Counting(AnswerStore):
        def answered(self, asked, compute, part):
            def counted(new):
                computed.append(sorted(r._query for r in new.collect()))
                return compute(new)

            return super().answered(asked, counted, part)

    index = P.PlaceIndex(plain.rows, plain.postings, plain.frequency, known=Counting(spark, store.path))
    batch = spark.createDataFrame([("madrid", "es"), ("atlantis", "es"), (None, None)], "t string, c string")
    on = {"place_name": "t", "country_code": "c"}
    rows = lambda df: sorted((str(r.t), r.geo_zip_code) for r in df.collect())
    expected = [("None", None), ("atlantis", None), ("madrid", "M")]
    assert rows(P.lookup_place(batch, index, on)) == expected
    assert rows(P.lookup_place(batch, index, on)) == expected  # misses are known too
    assert len(computed) == 1 and len(computed[0]) == 2
    more = batch.union(spark.createDataFrame([("bilbao", "es")], batch.schema))
    assert rows(P.lookup_place(more, index, on)) == [("None", None), ("atlantis", None), ("bilbao", "B"), ("madrid", "M")]
    assert len(computed) == 2 and len(computed[1]) == 1
    # Other operators ask other questions with the same text.
    assert rows(P.lookup_place(batch, index, on, "OR"))[1] == ("atlantis", "M") and len(computed) == 3
