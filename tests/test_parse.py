import pytest
from pyspark.sql import functions as F

from wayline.config import ImportConfig, ImportOptions, output_schema, parse_constants
from wayline.operators import parse
from wayline.plans.report import load_report
from wayline.sources.lines import scan_lines, with_order

CFG = ImportConfig("i", "t", {"a": "long", "b": "float", "c": "keyword"}, ("a", "b", "c"))


def lines(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string")


def test_absent_and_empty_fields_differ(spark):
    df = parse.accepted(parse.parse_lines(lines(spark, "1;;x", "1;2", "", "1;2;\t "), CFG.order_in_file))
    got = [tuple(r) for r in df.orderBy("n").collect()]
    assert got == [(0, "1", "", "x"), (1, "1", "2", None), (2, "", None, None), (3, "1", "2", "")]


@pytest.mark.parametrize("separator", [";", "|", ".", "\t", "||", ";;;", "\\E", "$^"])
def test_separators_are_literal(spark, separator):
    df = parse.parse_lines(lines(spark, separator.join(["1", "2", "x y"])), CFG.order_in_file, separator)
    assert tuple(df.select("a", "b", "c").first()) == ("1", "2", "x y")


def test_rejects(spark):
    parsed = parse.parse_lines(lines(spark, "1;2;3;4", "1;2;3", "1"), CFG.order_in_file, required=["b"])
    got = [tuple(r) for r in parse.rejected(parsed, ["n"]).orderBy("n").collect()]
    assert got == [(0, "1;2;3;4", "too many fields"), (2, "1", "missing id field")]
    assert parse.first_rejected(parse.rejected(parsed, ["n"]), "n", 1).count() == 1
    with pytest.raises(Exception, match="line rejected"):
        parse.apply_reject_policy(parsed, "fail")[0].collect()
    assert parse.apply_reject_policy(parsed, "drop")[0].count() == 1
    with pytest.raises(ValueError):
        parse.apply_reject_policy(parsed, "ignore")


def test_bad_fields_and_report(spark):
    parsed = parse.parse_typed(lines(spark, "1;x;y", "z;nan;y", ";1;y", "1;2;3;4"), CFG)
    got = {r.n: (r.a, r.b, r._bad_fields) for r in parsed.collect()}
    assert got == {0: (1, None, ["b"]), 1: (None, None, ["a"]), 2: (None, 1.0, []), 3: (1, 2.0, [])}
    assert tuple(load_report(parsed).first()) == (4, 3, 1, 2)


def test_lines_are_split_once(spark):
    df = parse.accepted(parse.parse_lines(lines(spark, "1;2;3").repartition(2), CFG.order_in_file))
    assert df._jdf.queryExecution().executedPlan().toString().count("split(") == 1


def test_scan_drops_bad_bytes_and_header(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b'h;h\n1;caf\xc3\xa9 \xff"x\n\n2;"b\n')
    assert [r.value for r in scan_lines(spark, str(tmp_path)).collect()] == ["h;h", '1;café "x', "", '2;"b']
    assert [r.value for r in scan_lines(spark, str(tmp_path), skip_header=True).collect()] == ['1;café "x', '2;"b']


def test_order_follows_the_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"{i:06d}\n" for i in range(40000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 30000)
    try:
        df = with_order(scan_lines(spark, str(tmp_path), positions=True))
        assert df.rdd.getNumPartitions() > 4
        got = [r.value for r in df.orderBy("seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [f"{i:06d}" for i in range(40000)]


def test_constants():
    assert parse_constants("a:b;;;c:d") == {"a": "b", "c": "d"}
    assert parse_constants(None) == {}
    with pytest.raises(ValueError):
        parse_constants("a:b:c")


def test_config_checks():
    text = '{"meta": {"index": "i", "type": "t"}, "properties": {"a": "long"}, "order_in_file": ["a"]}'
    cfg = ImportConfig.from_json(text)
    assert cfg.order_in_file == ("a",)
    for bad in ("{", '{"meta": {}}', text.replace('["a"]', '["b"]')):
        with pytest.raises(ValueError):
            ImportConfig.from_json(bad)
    with pytest.raises(ValueError, match="x is not in the config; column y"):
        ImportOptions(geo_precision="ip", geo_columns={"ip": "x"}, tor_column="y").check(cfg)
    for options in (
        ImportOptions(geo_precision="city", geo_columns={"ip": "a"}), ImportOptions(geo_precision="ip"),
        ImportOptions(geo_precision="ip", geo_columns={"zip_code": "a"}), ImportOptions(rejects="x"),
    ):
        with pytest.raises(ValueError):
            options.check(cfg)


def test_output_schema_lists_generated_columns():
    names = output_schema(CFG, ImportOptions(geo_precision="IP", tor_column="c", constants={"k": "v"})).names
    assert names[3:] == [
        "geo_country_code", "geo_country_name", "geo_location", "geo_place_name", "geo_region_name",
        "geo_representative_point", "geo_zip_code", "tor_info", "tor_is_exit_node", "tor_is_tor_server", "k",
    ]


def test_constants_overwrite(spark):
    df = parse.with_constants(spark.range(1).select(F.lit("x").alias("a")), {"a": "1", "b": "2"})
    assert tuple(df.first()) == ("1", "2")


def test_header_skip_keeps_lines_whole(spark, tmp_path):
    lines = ["head", "a;\x01b;c", "\x00q;r\x00;z", '"x";"', "#n", "\x01\x01p\x01", "plain"]
    # A line of blanks and control characters alone counts as blank.
    (tmp_path / "in.txt").write_text("\n".join([*lines, " \t", "\x01"]) + "\n")
    assert [r.value for r in scan_lines(spark, str(tmp_path), skip_header=True).collect()] == lines[1:]
