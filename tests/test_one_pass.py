"""One-pass imports with their reports, relay loads and the folding store."""

import pytest
from conftest import no_nested_loops_or_python, plan_of
from pyspark.sql import functions as F

from wayline import sinks
from wayline.config import ImportConfig, ImportOptions
from wayline.functions.casts import to_float
from wayline.operators.parse import parse_typed
from wayline.plans import tables as builds
from wayline.plans.import_job import LookupTables, import_documents, import_lines, tagged_import, write_import
from pyspark.sql import Observation

CFG = ImportConfig("logs", "hit", {"at": "date", "ip": "ip", "size": "float", "n": "integer"}, ("at", "ip", "size", "n"))
LINES = [
    (1, "1700000000;8.8.8.8;1.5;3"), (2, "x;1.0.0.1;y;4"), (3, "1;2;3;4;5;6"), (4, "1700000001"), (5, "1700000001;bad;;1e99"),
    (6, ""), (7, "1;;nan;7 \t"),
]


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines") / "in")
    spark.createDataFrame(LINES, "ordinal int, value string").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def relays(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("relays")
    (base / "exit").write_text("1.0.0.1\nnot an ip\n1.0.0.1 \n\n9.9.9.9\n")
    (base / "all").write_text("8.8.8.8\n1.0.0.1\n?\n?\n")
    return builds.load_relays(spark, str(base / "exit"), str(base / "all"), str(base / "built"))


def test_relay_loads_report_their_lists(relays):
    assert relays.exit_counts == {"lines": 4, "bad_lines": 1} and relays.server_counts == {"lines": 4, "bad_lines": 2}
    assert [r.ip_int for r in relays.missing_servers.collect()] == [9 * 0x01010101]


@pytest.mark.parametrize("documents", [False, True])
def test_one_write_holds_rows_rejects_and_bad_values(lines, relays, tmp_path, documents):
    options = ImportOptions(typed=True, tor_column="ip", constants={"k": "v"}, md5_id=True, md5_exclude=["size", "n", "ip"])
    given = LookupTables(relays=relays.relays)
    done = write_import(lines, CFG, options, str(tmp_path / "out"), given, documents=documents)
    apart = (import_documents(lines, CFG, options, given, keep=("ordinal",)) if documents else import_lines(lines, CFG, options, given))
    assert done.rows().columns == apart.rows.columns
    assert sorted(map(str, done.rows().collect())) == sorted(map(str, apart.rows.collect()))
    assert sorted(map(str, done.rejects().collect())) == sorted(map(str, apart.rejects.collect()))
    assert sorted((r.ordinal, r.field) for r in done.bad_fields().collect()) == [(2, "at"), (2, "size"), (5, "n")]
    assert {r.ordinal: r.line for r in done.bad_fields().collect()}[2] == LINES[1][1]
    assert done.counts == {"lines": 7, "success": 6, "failed": 1, "bad_fields": 3}
    marked, _, _ = tagged_import(lines, CFG, options, given, documents)
    assert plan_of(marked).count("FileScan parquet [ordinal") == 1
    no_nested_loops_or_python(marked)


def test_policies_of_a_one_pass_import(lines, tmp_path):
    drop = write_import(lines, CFG, ImportOptions(typed=True, rejects="drop"), str(tmp_path / "drop"))
    assert drop.rows().count() == 6 and drop.rejects().count() == 0 and drop.counts["failed"] == 1
    with pytest.raises(Exception, match="line rejected: too many fields"):
        write_import(lines, CFG, ImportOptions(typed=True, rejects="fail"), str(tmp_path / "fail"))
    untyped = write_import(lines.where("ordinal <> 3"), CFG, ImportOptions(rejects="fail"), str(tmp_path / "ok"))
    assert untyped.rows().count() == 6 and untyped.bad_fields().count() == 0
    again = write_import(lines, CFG, ImportOptions(), str(tmp_path / "ok"), replace=True)
    assert again.rows().count() == 6 and again.rejects().count() == 1
    empty = write_import(lines.limit(0), CFG, ImportOptions(typed=True), str(tmp_path / "empty"))
    assert empty.rows().count() == 0 and empty.rejects().count() == 0


def test_documents_report_their_counts(lines):
    counts = Observation()
    found = import_documents(lines, CFG, ImportOptions(typed=True), counts=counts)
    found.rows.write.format("noop").mode("overwrite").save()
    assert counts.get == {"lines": 7, "success": 6, "failed": 1, "bad_fields": 3}


def test_digits_of_other_scripts_are_numbers(spark):
    texts = ["١٢.٥", "१_०e١", "+٣", "\U0001d7d9\U0001d7d8", "１２　", "٣x", "²", "½", "1२"]
    def number(text):
        try:
            return float(text)
        except ValueError:
            return None
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", to_float(F.col("t")).alias("f"))
    assert {r.t: r.f for r in df.collect()} == {t: number(t) for t in texts}
    cfg = ImportConfig("i", "t", {"n": "integer"}, ("n",))
    assert parse_typed(spark.createDataFrame([("٤٢",)], "value string"), cfg).first().n == 42


def docs(spark, rows):
    return spark.createDataFrame(rows, "_id string, v int, _seq bigint")


def current(spark, path):
    return {r._id: r.v for r in sinks.current_documents(spark, path).collect()}


def test_store_folds_under_writers(spark, tmp_path):
    path = str(tmp_path / "store")
    first, second = "1-00000000000001-a", "1-00000000000002-b"
    sinks.write_batch(docs(spark, [("a", 1, 0), ("b", 1, 1), ("a", 2, 2)]), path, 0, run=first, session=first)
    sinks.write_batch(docs(spark, [("c", 3, 0)]), path, 1, run=first, session=first)
    assert current(spark, path) == {"a": 2, "b": 1, "c": 3}
    assert sinks.fold(spark, path) == 2
    assert current(spark, path) == {"a": 2, "b": 1, "c": 3}
    # A retry of a folded batch changes nothing; a batch of another run goes on top.
    sinks.write_batch(docs(spark, [("a", 1, 0), ("b", 1, 1), ("a", 2, 2)]), path, 0, run=first, session=first)
    sinks.write_batch(docs(spark, [("b", 9, 0)]), path, 0, run=second, session=second)
    sinks.write_batch(docs(spark, [("c", 4, 0)]), path, 2, run=first, session=first)
    assert current(spark, path) == {"a": 2, "b": 9, "c": 4}
    assert len(sinks._live(spark, path)[1]) == 3  # the snapshot and two batches
    # A fold that ended before its manifest was written leaves a snapshot nobody reads.
    sinks.write_batch(docs(spark, [("z", 0, 0)]), path, 0, run=f"{sinks.SNAPSHOT}-00000002", session=sinks.SNAPSHOT)
    assert current(spark, path) == {"a": 2, "b": 9, "c": 4}
    assert sinks.fold(spark, path) == 3
    assert current(spark, path) == {"a": 2, "b": 9, "c": 4} and len(sinks._live(spark, path)[1]) == 1


def test_folded_store_can_be_compacted(spark, tmp_path):
    path, copy = str(tmp_path / "store"), str(tmp_path / "copy")
    sinks.write_batch(docs(spark, [("a", 1, 0)]), path, 0, run="1-00000000000001-a", session="1-00000000000001-a")
    sinks.fold(spark, path)
    sinks.compact(spark, path, copy)
    sinks.write_batch(docs(spark, [("a", 2, 0)]), copy, 0, run="1-00000000000002-a", session="1-00000000000002-a")
    sinks.fold(spark, copy)
    assert current(spark, copy) == {"a": 2}
