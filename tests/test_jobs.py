import gzip
from dataclasses import replace

import pytest
from conftest import no_nested_loops_or_python
from pyspark.sql import Observation
from pyspark.sql import functions as F

from wayline.config import ImportConfig, ImportOptions, output_schema
from wayline.operators import parse
from wayline.operators.ranges import lookup_ip
from wayline.plans import tables as builds
from wayline.plans.import_job import LookupTables, import_documents, import_lines
from wayline.plans.report import observed
from wayline.sinks import current_documents
from wayline.sources.lines import generate_lines, scan_lines
from wayline.sources.tables import address_set, read_relay_export
from wayline.streaming import imports as streaming

CFG = ImportConfig(
    "logs", "hit", {"at": "date", "ip": "ip", "country": "keyword", "place": "keyword", "size": "float"},
    ("at", "ip", "country", "place", "size"),
)
LINES = [
    "1700000000.5;8.8.8.8;es;madrid;1.5", "1700000001;1.0.0.1;XX;nowhere;x", "1700000002;bad;;;", "1700000003",
    "1;2;3;4;5;6", "1700000000.5;8.8.8.8;es;madrid;2.5", "",
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("sources")
    (base / "countries.csv").write_text('40.463667,-3.74922,"es","Spain"\n-22.5,17.25,"NA","NAMIBIA"\n1.5,2.5,"XK","Kosovo, Republic"\n0.5,0.5,NULL,"n/a"\n')
    with gzip.open(base / "ranges.csv.gz", "wt") as out:
        out.write('"0","134744063","-","-","-","-","0.0","0.0","-"\n')
        out.write('"134744064","134744319","US","United States","California","Mountain View","37.405992","-122.078515","94043"\n')
        out.write('"134744064","134744319","US","United States","California","Second","38.5","-121.5","94044"\n')
    (base / "places.csv").write_text("ES,28001,Madrid,Madrid,MD,,,,,40.4165,-3.7026,4\nES,48001,Bilbao,Pais Vasco,PV,,,,,43.2627,-2.9253,4\n")
    (base / "exit.txt").write_text("1.0.0.1\nnot an ip\n1.0.0.1 \n\n")
    (base / "all.txt").write_text("8.8.8.8\n")
    target = str(base / "built")
    return LookupTables(
        countries=builds.build_countries(spark, str(base / "countries.csv"), f"{target}/countries"),
        places=builds.build_places(spark, str(base / "places.csv"), f"{target}/places"),
        ranges=(builds.build_ip_ranges(spark, str(base / "ranges.csv.gz"), f"{target}/ranges"),
                builds.open_ip_ranges(spark, f"{target}/ranges"))[1],
        relays=builds.build_relays(spark, str(base / "exit.txt"), str(base / "all.txt"), f"{target}/relays"),
    )


def test_missing_values_and_case_of_the_country_table(spark, tables):
    got = {r._key_country_code: r.country_name for r in tables.countries.where("_mask = 1").collect()}
    assert got == {"ES": "SPAIN", "NA": "NAMIBIA", "XK": "KOSOVO, REPUBLIC"}


def test_ranges_sharing_an_end_are_merged(spark, tables):
    probe = spark.createDataFrame([("8.8.8.8",)], "ip string")
    row = lookup_ip(probe, "ip", tables.ranges).first()
    assert (row.geo_place_name, row.geo_location, row.geo_representative_point) == (
        "MOUNTAIN VIEW", "37.405992,-122.078515", "37.405992,-122.078515")
    assert tables.ranges.disjoint


def test_relays(spark, tables):
    assert {r.ip_int: (r.is_exit, r.is_server) for r in tables.relays.collect()} == {
        16777217: (True, False), 134744072: (False, True)}


def test_built_places_can_be_opened(spark, tables):
    path = tables.places.rows.inputFiles()[0].rsplit("/rows/", 1)[0].replace("file://", "")
    assert builds.open_places(spark, path).answers.count() == tables.places.answers.count()


def test_row_ids_follow_the_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text("".join(f"{i}.5,1.5,C{i},N{i}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 40000)
    try:
        rows = builds.with_row_ids(builds.read_countries(spark, str(tmp_path / "t.csv")))
        ordered = [r.country_code for r in rows.orderBy("row_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ordered == [f"C{i}" for i in range(20000)]


OPTIONS = [
    ImportOptions(),
    ImportOptions(typed=True, dates_in_seconds=True),
    ImportOptions(typed=True, geo_precision="IP", geo_columns={"ip": "ip"}, tor_column="ip", constants={"k": "v"}),
    ImportOptions(geo_precision="country_level", geo_columns={"country_code": "country"}, dates_in_seconds=True),
    ImportOptions(geo_precision="multilevel", geo_columns={"place_name": "place", "country_code": "country"}),
    ImportOptions(geo_precision="multilevel", geo_columns={"region_name": "place"}, tor_column="ip"),
]


@pytest.mark.parametrize("options", OPTIONS)
def test_import_schema_and_row_count(spark, tables, options):
    lines = spark.createDataFrame([(t,) for t in LINES], "value string")
    result = import_lines(lines, CFG, options, tables)
    assert {f.name: f.dataType for f in result.rows.schema} == {f.name: f.dataType for f in output_schema(CFG, options)}
    assert result.rows.count() + result.rejects.count() == len(LINES) and result.rejects.count() == 1
    no_nested_loops_or_python(result.rows)


def test_import_values(spark, tables):
    lines = spark.createDataFrame([(t,) for t in LINES], "value string")
    ip = import_lines(lines, CFG, OPTIONS[2], tables).rows.where("ip = '8.8.8.8' and size = 1.5").first()
    assert (ip.at, ip.geo_zip_code, ip.tor_info, ip.tor_is_exit_node, ip.k) == (1700000000, "94043", "TOR Server", False, "v")
    country = import_lines(lines, CFG, OPTIONS[3], tables).rows.where("country = 'es'").first()
    assert (country.at, country.geo_country_name, country.geo_location) == ("1700000000500", "SPAIN", "40.463667,-3.74922")
    place = import_lines(lines, CFG, OPTIONS[4], tables).rows.where("country = 'es'").first()
    assert (place.geo_zip_code, place.geo_country_name) == ("28001", None)


def test_ids_reject_lines_without_their_fields(spark, tables):
    lines = spark.createDataFrame([(t,) for t in LINES], "value string")
    result = import_documents(lines, CFG, ImportOptions(md5_id=True, md5_exclude=["size"]), tables)
    # The two lines that differ in the excluded column share an id.
    assert result.rows.count() == 4 and result.rows.select("_id").distinct().count() == 3
    assert result.rejects.count() == 3


def test_needed_tables_and_keys_are_checked(spark):
    lines = spark.createDataFrame([("1",)], "value string")
    with pytest.raises(ValueError, match="ranges"):
        import_lines(lines, CFG, OPTIONS[2])
    with pytest.raises(ValueError):
        import_lines(lines, CFG, ImportOptions(geo_precision="multilevel", geo_columns={"country_name": "country"}))


def test_address_lists(spark, tmp_path):
    (tmp_path / "list").write_text("1.0.0.1\n1.0.0.1  \nx\n2.0.0.1\n")
    assert sorted(r[0] for r in address_set(scan_lines(spark, str(tmp_path / "list"))).collect()) == [16777217, 33554433]
    (tmp_path / "export.csv").write_text("Name,IP Address,Flag - Exit\na,1.0.0.1,1\nb,2.0.0.1,0\n")
    for flag, ip in ((True, "1.0.0.1"), (False, "2.0.0.1")):
        assert [r[0] for r in read_relay_export(spark, str(tmp_path / "export.csv"), flag).collect()] == [ip]


def test_generated_lines_parse(spark):
    lines = generate_lines(spark.range(500))
    parsed = parse.parse_lines(lines, ("a", "b", "c", "d", "e", "f", "g"))
    assert parsed.where("_reject_reason is not null or g is null").isEmpty()
    assert parsed.where("id = 1").first().a == "1577836801000"
    assert [r.value for r in lines.collect()] == [r.value for r in generate_lines(spark.range(500)).collect()]


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.mark.parametrize("options", OPTIONS[:4])
def test_stateless_stream_equals_batch(spark, tables, tmp_path, options):
    source = tmp_path / "in"
    write(source, "1.txt", ["header", *LINES[:3]])
    write(source, "2.txt", ["header", *LINES[3:5]])
    batch = import_lines(scan_lines(spark, str(source), skip_header=True), CFG, options, tables).rows
    rows = import_lines(streaming.stream_lines(spark, str(source), skip_header=True), CFG, options, tables).rows
    out = str(tmp_path / "out")
    streaming.write_stream(rows, out, str(tmp_path / "state"), once=True).awaitTermination()
    written = spark.read.parquet(out).select(batch.columns)
    assert sorted(map(str, written.collect())) == sorted(map(str, batch.collect()))


def test_stream_upsert_survives_a_retry(spark, tables, tmp_path):
    source, out, options = tmp_path / "in", str(tmp_path / "out"), ImportOptions(
        md5_id=True, md5_exclude=["size", "at"], geo_precision="multilevel", geo_columns={"place_name": "place"})

    def load(state):
        lines = streaming.stream_lines(spark, str(source), max_files=1)
        streaming.import_stream(lines, CFG, options, tables, out, str(tmp_path / state), once=True).awaitTermination()
        docs = current_documents(spark, out)
        return {r._id: (r.size, r.geo_zip_code) for r in docs.collect()}

    write(source, "1.txt", ["1;8.8.8.8;es;madrid;1", "2;8.8.8.8;es;madrid;2"])
    first = load("state")
    assert list(first.values()) == [("2", "28001")]
    assert load("another state") == first  # the same batch again, as after a lost checkpoint
    write(source, "2.txt", ["3;8.8.8.8;es;madrid;3", "4;1.1.1.1;es;bilbao;4"])
    assert sorted(load("state").values()) == [("3", "28001"), ("4", "48001")]


def test_stream_rejects_are_kept_and_counted(spark, tables, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    write(source, "1.txt", LINES[:5])
    counts = {}
    listener = streaming.LoadListener()

    def report(batch_id, found):
        counts[batch_id] = found
        listener.add(batch_id, found)

    lines = streaming.stream_lines(spark, str(source))
    streaming.import_stream(lines, CFG, ImportOptions(typed=True), tables, out, str(tmp_path / "s"), once=True, report=report).awaitTermination()
    assert counts == {0: {"lines": 5, "success": 4, "failed": 1, "bad_fields": 1}} and listener.totals == counts[0]
    assert spark.read.parquet(f"{out}_rejects").count() == 1 and spark.read.parquet(out).count() == 4


def test_stream_counts(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "1.txt", LINES[:5])
    listener = streaming.LoadListener()
    spark.streams.addListener(listener)
    try:
        parsed = parse.parse_typed(streaming.stream_lines(spark, str(source)), CFG)
        query = streaming.write_stream(parse.accepted(observed(parsed)), str(tmp_path / "o"), str(tmp_path / "s"), once=True)
        query.awaitTermination()
        progress = [p.observedMetrics["load"] for p in query.recentProgress if "load" in p.observedMetrics]
    finally:
        spark.streams.removeListener(listener)
    assert (progress[0].lines, progress[0].success, progress[0].failed, progress[0].bad_fields) == (5, 4, 1, 1)


def test_observed_batch(spark):
    seen = Observation("load")
    parsed = parse.parse_typed(spark.createDataFrame([(t,) for t in LINES], "value string"), CFG)
    parse.accepted(observed(parsed, seen)).write.format("noop").mode("overwrite").save()
    assert seen.get == {"lines": 7, "success": 6, "failed": 1, "bad_fields": 1}


def test_repeated_ids_in_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "1.txt", ["1700000000;a", "1700000001;a", "1700000002;b"])
    parsed = parse.accepted(parse.parse_lines(streaming.stream_lines(spark, str(source)), ("at", "_id")))
    kept = streaming.drop_repeated_ids(parsed, F.timestamp_seconds(F.col("at").cast("bigint")), "1 hour")
    streaming.write_stream(kept, str(tmp_path / "o"), str(tmp_path / "s"), once=True).awaitTermination()
    assert sorted(r._id for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["a", "b"]


def test_import_with_ranges_too_large_to_broadcast(spark, tables):
    """The address that both lookups share is parsed once; the shuffled range join takes it too."""
    options = ImportOptions(typed=True, geo_precision="ip", geo_columns={"ip": "ip"}, tor_column="ip")
    large = replace(tables, ranges=replace(tables.ranges, max_rows=0))
    assert large.ranges.broadcast_bits() != list(large.ranges.bits)
    lines = spark.createDataFrame([(line,) for line in LINES], "value string")
    rows = [sorted(map(repr, import_lines(lines, CFG, options, t).rows.collect())) for t in (tables, large)]
    assert rows[0] == rows[1] and any("MOUNTAIN VIEW" in r for r in rows[1])
