import sqlite3

import pytest
from conftest import no_nested_loops_or_python, plan_of
from pyspark.sql import functions as F

from wayline.operators import places as P
from wayline.operators import sizing
from wayline.sources.tables import PLACE_COLUMNS

# Known places, and decoys.
ROWS = [
    ("ES", "28001", "MADRID", "MADRID", "MD", "MADRID", "M", "MADRID", "28079", 40.4165, -3.7026, 4.0),
    ("ES", "48001", "BILBAO", "PAIS VASCO", "PV", "VIZCAYA", "BI", "BILBAO", "48020", 43.2627, -2.9253, 4.0),
    ("FR", "75000", "PARIS", "ÎLE-DE-FRANCE", "11", "PARIS", "75", "PARIS", "751", 48.8534, 2.3488, 5.0),
    ("FR", "69000", "LYON", "AUVERGNE", "84", "RHÔNE", "69", None, None, 45.75, 4.85, 5.0),
    ("FR", "13000", "MARSEILLE", "PROVENCE", "93", "BOUCHES", "13", None, None, 43.25, 5.5, 5.0),
    ("US", "10001", "NEW YORK", "NEW YORK", "NY", None, None, None, None, 40.75, -74.0, 4.0),
    ("GB", "YO1", "YORK", "ENGLAND", "ENG", None, None, None, None, 53.96, -1.08, 4.0),
    ("US", "40000", "NEW MADRID", "MISSOURI", "MO", None, None, None, None, 36.5, -89.5, 4.0),
]


@pytest.fixture(scope="module")
def index(spark):
    types = ["string"] * 9 + ["double"] * 3
    schema = ", ".join(f"{c} {t}" for c, t in zip(PLACE_COLUMNS, types)) + ", row_id bigint"
    return P.place_index(spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], schema))


def one(spark, index, on, op="AND", scope="first_token"):
    probe = spark.createDataFrame([tuple(on.values())], ", ".join(f"v{i} string" for i in range(len(on))))
    df = P.lookup_place(probe, index, {k: f"v{i}" for i, k in enumerate(on)}, op, scope)
    return {k[4:]: v for k, v in df.first().asDict().items() if k.startswith("geo_")}


MADRID = {
    "accuracy": 4.0, "admin_code1": "MD", "admin_code2": "M", "admin_code3": "28079", "admin_name1": "MADRID",
    "admin_name2": "MADRID", "admin_name3": "MADRID", "country_code": "ES", "country_name": None,
    "location": "40.4165,-3.7026", "place_name": "MADRID", "representative_point": "40.4165,-3.7026", "zip_code": "28001",
}


def test_three_keys_in_any_case(spark, index):
    for values in (("MADRID", "MADRID", "ES"), ("madrid", "madrid", "es")):
        assert one(spark, index, dict(zip(("place_name", "admin_name1", "country_code"), values))) == MADRID


def test_unknown_column_searches_everywhere(spark, index):
    assert one(spark, index, {"country_name": "spain"})["place_name"] is None
    assert one(spark, index, {"": "BILBAO"})["zip_code"] == "48001"


def test_many_matches(spark, index):
    got = one(spark, index, {"country_code": "FR"})
    assert (got["zip_code"], got["location"], got["representative_point"]) == ("75000", "48.8534,2.3488", "45.75,4.85")


def test_bad_arguments(spark, index):
    probe = spark.createDataFrame([("x",)], "v string")
    for on, op, scope in (({}, "AND", "column"), ({"": "v"}, "XOR", "column"), ({"": "v"}, "AND", "word")):
        with pytest.raises(ValueError):
            P.lookup_place(probe, index, on, op, scope)
    with pytest.raises(ValueError):
        P.check_place_keys({"country_name": "v"})


# Conditions of one query; text searched as data has no operators in it.
QUERIES = [
    ([("place_name", "madrid")], "AND"), ([("place_name", "new york")], "AND"), ([("", "york")], "AND"),
    ([("", "new madrid")], "AND"), ([("place_name", "york"), ("country_code", "us")], "AND"),
    ([("place_name", "york"), ("country_code", "us")], "OR"), ([("country_code", "us"), ("place_name", "york")], "NOT"),
    ([("place_name", "new york"), ("country_code", "es")], "OR"), ([("country_code", "fr"), ("zip_code", "69000")], "NOT"),
    ([("admin_name1", "ile")], "AND"), ([("admin_name2", "rhone")], "AND"), ([("zip_code", "nothing")], "AND"),
    ([("latitude", "40")], "AND"), ([("country_code", "us"), ("place_name", "york"), ("place_name", "madrid")], "NOT"),
    ([("place_name", "new madrid"), ("admin_name1", "missouri")], "AND"),
]


def test_matches_agree_with_a_full_text_index(spark, index):
    con = sqlite3.connect(":memory:")
    con.execute(f"CREATE VIRTUAL TABLE t USING fts5({','.join(PLACE_COLUMNS)})")
    for i, row in enumerate(ROWS):
        con.execute(f"INSERT INTO t(rowid, {','.join(PLACE_COLUMNS)}) VALUES ({i}, {','.join('?' * 12)})", row)
    for conditions, op in QUERIES:
        text = f" {op} ".join(f"{c}:{v}" if c else v for c, v in conditions)
        expected = [r[0] for r in con.execute("SELECT rowid FROM t WHERE t MATCH ? ORDER BY rowid", (text,))]
        parts = [P.condition_terms(c, F.lit(v), "first_token") for c, v in conditions]
        joined = F.array_join(F.flatten(F.array(*parts)), " ") if op == "AND" else F.array_join(F.array(*[F.array_join(p, " ") for p in parts]), "|")
        query = spark.range(1).select(joined.alias("_query"))
        term = query.first()[0]
        if "|" in term and op == "OR":
            asked, _, rows = P._union_sets(query, index)
            sets = asked.select(F.explode("_names").alias("_name"))
            got = sorted(r._row for r in rows.join(sets, "_name").select("_row").distinct().collect())
        elif " " in term or "|" in term:
            got = sorted(r.row_id for r in P._matches(query, index, op).collect())
        else:
            got = sorted(r.row_id for r in index.postings.where(F.col("term") == term).collect())
        assert got == expected, text


def test_words_are_data(spark, index):
    for value in ("", "--", 'a"b', "it's", "OR", "NOT x"):
        assert one(spark, index, {"place_name": value})["place_name"] is None
    assert one(spark, index, {"place_name": "madrid", "country_code": ""})["place_name"] is None
    assert one(spark, index, {"place_name": '"new" (york)'})["zip_code"] == "10001"


def test_null_keys_take_no_part(spark, index):
    probe = spark.createDataFrame([(0, None, "es"), (1, "york", None), (2, None, None)], "n int, p string, c string")
    df = P.lookup_place(probe, index, {"place_name": "p", "country_code": "c"})
    assert {r.n: r.geo_zip_code for r in df.collect()} == {0: "28001", 1: "10001", 2: None}
    no_nested_loops_or_python(df)


def test_column_scope(spark, index):
    assert one(spark, index, {"place_name": "york england"})["zip_code"] == "YO1"
    assert one(spark, index, {"place_name": "york england"}, scope="column")["zip_code"] is None


def test_a_large_table_from_one_file_is_spread(spark, tmp_path, monkeypatch):
    """One small file is one task, and so was all that its rows grow into."""
    monkeypatch.setattr(sizing.spread, "__kwdefaults__", {**sizing.spread.__kwdefaults__, "rows": 100})
    none = [F.lit(None).cast("string").alias(c) for c in PLACE_COLUMNS[3:9]]
    name, zero = F.lit("SAME PLACE").alias("place_name"), [F.lit(0.0).alias(c) for c in PLACE_COLUMNS[9:]]
    key = F.col("id").cast("string")
    table = spark.range(1000).select(F.lit("ES").alias("country_code"), key.alias("zip_code"), name, *none, *zero, F.col("id").alias("row_id"))
    table.coalesce(1).write.parquet(str(tmp_path / "places"))
    index = P.place_index(spark.read.parquet(str(tmp_path / "places")))
    held = [r.n for r in index.postings.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    total = sum(held)
    assert len(held) >= 8 and max(held) <= total / 4
    assert index.frequency.where("term = '*:same'").first().n == 1000
    plan = plan_of(index.postings)
    assert "translate" not in plan[plan.index("Exchange"):]  # words are split after the rows are spread, and once
    assert P.place_rows(table.limit(50).coalesce(1)).rdd.getNumPartitions() == 1
