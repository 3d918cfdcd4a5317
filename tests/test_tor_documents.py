import json

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from wayline import sinks
from wayline.operators.documents import latest_by_id, merge_documents, to_documents
from wayline.operators.tor import missing_servers, relay_table, tag_relays

A, B, C, D = "1.0.0.1", "1.0.0.2", "1.0.0.3", "1.0.0.4"
N = 16777216


@pytest.fixture
def relays(spark):
    exits = spark.createDataFrame([(N + 1,), (N + 2,)], "ip_int bigint")
    servers = spark.createDataFrame([(N + 1,), (N + 3,)], "ip_int bigint")
    return exits, servers, relay_table(exits, servers)


# Address, label, exit flag, server flag.
TRUTH = [
    (A, "TOR Exit Node", True, True), (B, "TOR Exit Node", True, False), (C, "TOR Server", False, True),
    (D, "None", False, False), (None, "Invalid IP", False, False), ("", "Invalid IP", False, False), ("1.0.0.x", "Invalid IP", None, None),
]


def test_labels(spark, relays):
    df = tag_relays(spark.createDataFrame([(t[0],) for t in TRUTH], "ip string"), "ip", relays[2])
    assert {tuple(r) for r in df.collect()} == set(TRUTH)
    assert [r[0] for r in missing_servers(relays[0], relays[1]).collect()] == [N + 2]


def test_integer_addresses(spark, relays):
    df = tag_relays(spark.createDataFrame([(N + 1,), (None,)], "ip bigint"), "ip", relays[2], int_ip=True)
    assert {r.ip: r.tor_info for r in df.collect()} == {N + 1: "TOR Exit Node", None: "Invalid IP"}
    text = tag_relays(spark.createDataFrame([(A,)], "ip string"), "ip", relays[2], int_ip=True)
    assert tuple(text.first())[1:] == ("None", False, False)


def test_last_document_wins_and_hot_ids_are_trimmed_early(spark):
    df = spark.range(3000).select(F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("_id"))
    last = latest_by_id(df.repartition(6), ["seq"])
    assert last.where("_id = 'hot'").first().seq == 2997 and last.count() == 2001
    assert plan_of(last).count("WindowGroupLimit") == 2


def test_merge(spark):
    current = spark.createDataFrame([("a", 9, "old"), ("b", 1, "old")], "_id string, seq int, v string")
    updates = spark.createDataFrame([("a", 1, "new"), ("a", 2, "newer"), ("c", 1, "new")], "_id string, seq int, v string")
    assert {r._id: r.v for r in merge_documents(current, updates).collect()} == {"a": "newer", "b": "old", "c": "new"}


def test_envelope(spark):
    df = spark.createDataFrame([("k", 1, None)], "_id string, n int, t string")
    row = to_documents(df, "i", "d", "_id").first()
    assert (row._id, row._index, row._type, json.loads(row._source)) == ("k", "i", "d", {"n": 1})


def test_write_modes(spark, tmp_path):
    df = spark.range(10).select(F.col("id").cast("string").alias("_id"))
    path = str(tmp_path / "docs")
    sinks.write_documents(df, path, replace=True, partitions=3, by_id="_id")
    sinks.write_documents(df, path, compression="gzip")
    assert spark.read.parquet(path).count() == 20
    sinks.write_documents(df, path, replace=True, partitions=2)
    assert spark.read.parquet(path).count() == 10
    assert len(list((tmp_path / "docs").glob("*.parquet"))) == 2


def test_tables(spark):
    df = spark.range(3).select("id", F.lit("x").alias("t"))
    sinks.write_table(df, "wayline_docs")
    sinks.write_table(df.select("t", "id"), "wayline_docs")
    assert spark.table("wayline_docs").count() == 6
    with pytest.raises(ValueError):
        sinks.ensure_table(spark, "wayline_docs", spark.range(1).schema)
    spark.sql("DROP TABLE wayline_docs")


def test_dry_run_counts_rows(spark):
    run = sinks.dry_run(spark.range(1234).select(F.sqrt("id").alias("x")))
    assert run.rows == 1234 and run.rows_per_second > 0


def test_batches_and_compaction(spark, tmp_path):
    path, snapshot = str(tmp_path / "b"), str(tmp_path / "s")
    make = lambda v, *ids: spark.createDataFrame([(i, n, v) for n, i in enumerate(ids)], "_id string, _seq int, v string")
    sinks.write_batch(make("one", "a", "b"), path, 0)
    sinks.write_batch(make("broken", "a"), path, 1)
    sinks.write_batch(make("two", "b", "c"), path, 1)
    expected = {"a": "one", "b": "two", "c": "two"}
    assert {r._id: r.v for r in sinks.current_documents(spark, path).collect()} == expected
    sinks.compact(spark, path, snapshot)
    assert {r._id: r.v for r in sinks.current_documents(spark, snapshot).collect()} == expected
    # A new run that begins at batch 0 again follows the snapshot and leaves it whole.
    sinks.write_batch(make("three", "c", "d"), snapshot, 0, run=sinks.new_name(), session=sinks.new_name())
    assert {r._id: r.v for r in sinks.current_documents(spark, snapshot).collect()} == {**expected, "c": "three", "d": "three"}
    with pytest.raises(ValueError):
        sinks.compact(spark, path, snapshot)
