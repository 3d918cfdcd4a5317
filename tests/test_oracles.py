"""Every registered query against its SQL twin on the small tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from wayline.plans.catalog import QUERIES
from wayline.plans.oracles import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are absent")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_every_library_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query(spark, sql, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    cursor = sql.execute(entry_points.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    expected = [tuple(map(str, row)) for row in cursor.fetchall()]
    got = [tuple(str(row[c]) for c in names) for row in df.collect()]
    assert sorted(got) == sorted(expected)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["geo_country_code", "events"] and df.count() > 0
