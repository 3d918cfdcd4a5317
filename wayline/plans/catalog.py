"""Registered queries: each operator over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline import sinks
from wayline.config import ImportOptions
from wayline.functions import ip as ips
from wayline.functions.casts import is_nan_or_inf, seconds_text_to_ms, to_date_ms, to_float
from wayline.functions.ids import document_id
from wayline.functions.text import location_text, words
from wayline.operators import documents, parse, places as place_ops, ranges as range_ops, tor
from wayline.operators.answers import AnswerStore
from wayline.operators.first_match import first_match
from wayline.operators.lookup import COUNTRY, IP_RANGE_PLACES, key_answers, lookup, lookup_any
from wayline.plans import fixtures as fx
from wayline.plans import tables as table_builds
from wayline.plans.import_job import LookupTables, import_documents, import_lines, write_import
from wayline.plans.report import load_report
from wayline.scratch import shared_folder, stored
from wayline.sources.lines import generate_lines, scan_lines
from wayline.sources.tables import (
    COUNTRY_COLUMNS,
    IP_RANGE_COLUMNS,
    PLACE_COLUMNS,
    address_set,
    read_relay_export,
)
from wayline.streaming.imports import LoadListener, import_stream, stream_lines, write_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


_BUILT: set[str] = set()


def _built(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A lookup table, built once per application and read by every later query."""
    path = shared_folder(spark, f"{name}/{sf_dir.strip('/').replace('/', '-')}")
    if path not in _BUILT:
        make().write.mode("overwrite").parquet(path)
        _BUILT.add(path)
    return spark.read.parquet(path)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# ---------------------------------------------------------------- scalar functions


@query
def ip_to_int(spark, sf_dir):
    probes = fx.probe_ips(spark, sf_dir)
    return probes.select("event_id", "ip", ips.ip_to_int("ip").alias("ip_int"))


@query
def int_to_ip(spark, sf_dir):
    return fx.event_ips(spark, sf_dir).select("event_id", ips.int_to_ip("ip").alias("ip"))


@query
def cidr_filter(spark, sf_dir):
    return fx.event_ips(spark, sf_dir).where(
        ips.in_network("ip", "160.0.0.0/5") | ips.in_network("ip", "10.0.0.0/8") | ips.in_network("ip", "77.1.0.0/8")
    )


@query
def nan_inf(spark, sf_dir):
    e = F.col("event_id")
    text = (
        F.when(e % 5 == 0, "nan").when(e % 7 == 0, "-inf").when(e % 11 == 0, "+inf").when(e % 13 == 0, "inf")
        .otherwise(F.col("value").cast("string"))
    )
    events = fx.table(spark, sf_dir, "events")
    return events.select("event_id", is_nan_or_inf(to_float(text)).alias("nan_or_inf"))


@query
def date_ms(spark, sf_dir):
    seconds = F.concat((F.col("event_id") + 1519995883).cast("string"), F.lit(".3099031"))
    events = fx.table(spark, sf_dir, "events")
    return events.select(
        "event_id", to_date_ms(seconds, in_seconds=True).alias("from_seconds"), to_date_ms(seconds).alias("as_ms")
    )


@query
def date_suffix(spark, sf_dir):
    e = F.col("event_id")
    seconds = F.when(e % 4 == 0, F.concat((e + 1519995883).cast("string"), F.lit(".25"))).when(
        e % 9 != 0, (e + 1519995883).cast("string")
    )
    return fx.table(spark, sf_dir, "events").select("event_id", seconds_text_to_ms(seconds).alias("ms_text"))


@query
def location_fmt(spark, sf_dir):
    lat, lon = fx.quarter_degrees(F.col("p_partkey"))
    small = F.when(F.col("p_partkey") % 3 == 0, F.lit(0.0005)).when(F.col("p_partkey") % 5 == 0, F.lit(-0.00005))
    return fx.table(spark, sf_dir, "part").select(
        "p_partkey", location_text(F.coalesce(small, lat), F.when(F.col("p_partkey") % 11 != 0, lon)).alias("location")
    )


@query
def tokenize(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(" ", words(F.col("text"))).alias("words"))


@query
def doc_id(spark, sf_dir):
    short = F.when(F.col("event_id") % 4 != 0, F.col("props")).alias("props")
    events = fx.table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", short)
    return events.select("event_id", document_id(["event_type", "user_id", "props", "event_id"], ["event_id"]).alias("_id"))


# ---------------------------------------------------------------- sources


def _line_folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    folder = shared_folder(spark, name)
    fx.event_lines(spark, sf_dir).select("value").write.mode("overwrite").text(folder)
    return folder


@query
def scan_lines_query(spark, sf_dir):
    return scan_lines(spark, _line_folder(spark, sf_dir, "scan_lines")).select("value")


@query
def skip_header(spark, sf_dir):
    folder = shared_folder(spark, "skip_header")
    lines = fx.event_lines(spark, sf_dir).select(F.regexp_replace("value", ";abc;", ';"abc;').alias("id;at;size;kind"))
    lines.write.mode("overwrite").option("header", True).option("sep", "\u0001").option("quote", "").option(
        "escapeQuotes", False
    ).option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(folder)
    return scan_lines(spark, folder, skip_header=True).select("value")


@query
def stream_lines_query(spark, sf_dir):
    source = _line_folder(spark, sf_dir, "stream_lines/in")
    parsed = parse.parse_typed(stream_lines(spark, source), fx.LINE_CONFIG)
    target, state = shared_folder(spark, "stream_lines/out"), shared_folder(spark, "stream_lines/state")
    run = uuid.uuid4().hex  # a stream resumes from its state folder, so each run has its own
    write_stream(parse.accepted(parsed), f"{target}/{run}", f"{state}/{run}", once=True).awaitTermination()
    return spark.read.schema(fx.LINE_CONFIG.schema(typed=True)).parquet(f"{target}/{run}")


@query
def gen_lines(spark, sf_dir):
    return generate_lines(fx.table(spark, sf_dir, "events"), "event_id")


@query
def tor_set_load(spark, sf_dir):
    folder = shared_folder(spark, "tor_set_load")
    e = F.col("event_id")
    text = F.when(e % 13 == 0, F.lit("no address")).otherwise(F.concat(fx.dotted(fx.hashed_address(e % 5000)), F.lit(" ")))
    fx.table(spark, sf_dir, "events").select(text).write.mode("overwrite").text(folder)
    return address_set(scan_lines(spark, folder))


@query
def tor_export_filter(spark, sf_dir):
    folder = shared_folder(spark, "tor_export_filter")
    fx.event_ips(spark, sf_dir).select(
        fx.dotted(F.col("ip")).alias("IP Address"),
        F.when(F.col("event_id") % 50 == 0, 1).otherwise(0).alias("Flag - Exit"),
    ).write.mode("overwrite").option("header", True).csv(folder)
    return read_relay_export(spark, folder, exit_nodes=True)


# ---------------------------------------------------------------- lookup-table builds


def _country_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    code = (
        F.when(key % 11 == 0, "NA").when(key % 13 == 0, "NULL").when(key % 17 == 0, "n/a").otherwise(F.col("p_brand"))
    )
    name = F.concat(F.col("p_type"), F.lit(", "), F.col("p_name"))
    return fx.table(spark, sf_dir, "part").select(*fx.quarter_degrees(key), code.alias("code"), name.alias("name"))


@query
def dim_country(spark, sf_dir):
    folder = shared_folder(spark, "dim_country")
    _country_rows(spark, sf_dir).write.mode("overwrite").csv(f"{folder}/source")
    table_builds.build_countries(spark, f"{folder}/source", f"{folder}/built")
    return spark.read.parquet(f"{folder}/built/rows").select(*COUNTRY_COLUMNS)


@query
def dim_ip_range(spark, sf_dir):
    folder = shared_folder(spark, "dim_ip_range")
    raw = fx.raw_ranges(spark, sf_dir).repartitionByRange("row_id").sortWithinPartitions("row_id")
    raw.select(*IP_RANGE_COLUMNS).write.mode("overwrite").option("compression", "gzip").csv(f"{folder}/source")
    return table_builds.build_ip_ranges(spark, f"{folder}/source", f"{folder}/built")


@query
def dim_place(spark, sf_dir):
    folder = shared_folder(spark, "dim_place")
    fx.places(spark, sf_dir).select(*PLACE_COLUMNS).write.mode("overwrite").csv(f"{folder}/source")
    index = table_builds.build_places(spark, f"{folder}/source", f"{folder}/built")
    return index.rows.select(*PLACE_COLUMNS, F.concat_ws(" ", F.array_sort("terms")).alias("terms"))


@query
def term_frequency(spark, sf_dir):
    return place_ops.place_index(fx.places(spark, sf_dir)).frequency


# ---------------------------------------------------------------- parsing and rejects


@query
def parse_lines(spark, sf_dir):
    return parse.accepted(parse.parse_lines(fx.event_lines(spark, sf_dir), fx.LINE_CONFIG.order_in_file))


@query
def typed_cast(spark, sf_dir):
    size = F.split(F.col("value"), ";").getItem(2)
    raw = fx.event_lines(spark, sf_dir).select("ordinal", *[size.alias(f"as_{t}") for t in ("integer", "long", "float", "keyword")])
    return parse.cast_columns(raw, {f"as_{t}": t for t in ("integer", "long", "float", "keyword")}).drop(parse.BAD_FIELDS)


@query
def parse_typed(spark, sf_dir):
    return parse.accepted(parse.parse_typed(fx.event_lines(spark, sf_dir), fx.LINE_CONFIG))


@query
def parse_untyped(spark, sf_dir):
    return parse.accepted(parse.parse_untyped(fx.event_lines(spark, sf_dir), fx.LINE_CONFIG))


@query
def extra_cols(spark, sf_dir):
    parsed = parse.accepted(parse.parse_untyped(fx.event_lines(spark, sf_dir), fx.LINE_CONFIG))
    return parse.with_constants(parsed, {"service": "mail", "kind": "fixed"})


@query
def rejects(spark, sf_dir):
    parsed = parse.parse_lines(fx.event_lines(spark, sf_dir), fx.LINE_CONFIG.order_in_file, required=["kind"])
    return parse.rejected(parsed, ["ordinal"])


@query
def rejects_topn(spark, sf_dir):
    parsed = parse.parse_lines(fx.event_lines(spark, sf_dir), fx.LINE_CONFIG.order_in_file)
    return parse.first_rejected(parse.rejected(parsed, ["ordinal"]), "ordinal", 100)


@query
def reject_policy(spark, sf_dir):
    parsed = parse.parse_typed(fx.event_lines(spark, sf_dir), fx.LINE_CONFIG)
    kept, _ = parse.apply_reject_policy(parsed, "drop")
    return kept.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query
def load_report_query(spark, sf_dir):
    return load_report(parse.parse_typed(fx.event_lines(spark, sf_dir), fx.LINE_CONFIG))


# ---------------------------------------------------------------- key lookups


@query
def first_per_key(spark, sf_dir):
    table = fx.points(spark, sf_dir)
    return first_match(table, ["country_code"], ["country_name"]).drop("representative_point")


@query
def repr_point(spark, sf_dir):
    table = fx.points(spark, sf_dir)
    return first_match(table, ["country_code"], ["country_name"]).select("country_code", "representative_point")


def _key_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return fx.table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("Brand#"), (e % 30).cast("string")).alias("brand"),
        F.when(e % 7 == 0, "tiny").when(e % 3 == 0, "Economy").otherwise("promo").alias("kind"),
        F.when(e % 2 == 0, F.concat(F.lit("brand#"), (e % 30).cast("string"))).alias("maybe_brand"),
        F.when(e % 3 == 0, "Economy").alias("maybe_kind"),
    )


@query
def country_by_code(spark, sf_dir):
    answers = key_answers(fx.points(spark, sf_dir), COUNTRY, ["country_code"])
    return answers.where(F.col("_key_country_code") == "BRAND#12").drop("_mask", "_key_country_code")


@query
def geo_country(spark, sf_dir):
    probes = _key_probes(spark, sf_dir).select("event_id", "brand", "kind")
    return lookup(probes, fx.points(spark, sf_dir), COUNTRY, {"country_code": "brand", "country_name": "kind"})


@query
def geo_country_dynamic(spark, sf_dir):
    probes = _key_probes(spark, sf_dir).select("event_id", "maybe_brand", "maybe_kind")
    on = {"country_code": "maybe_brand", "country_name": "maybe_kind"}
    return lookup(probes, fx.points(spark, sf_dir), COUNTRY, on, optional_keys=True)


@query
def lookup_or(spark, sf_dir):
    probes = _key_probes(spark, sf_dir).select("event_id", "maybe_brand", "kind")
    return lookup_any(probes, fx.points(spark, sf_dir), COUNTRY, {"country_code": "maybe_brand", "country_name": "kind"})


@query
def geo_range_by_key(spark, sf_dir):
    e = F.col("event_id")
    probes = fx.table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("nation_"), (e % 27).cast("string")).alias("nation"),
        F.concat(F.lit("place "), (e % 101).cast("string")).alias("place"),
    )
    table = fx.raw_ranges(spark, sf_dir)
    return lookup(probes, table, IP_RANGE_PLACES, {"country_code": "nation", "place_name": "place"})


# ---------------------------------------------------------------- address lookups

_RANGE_COLUMNS = (*range_ops.ATTRIBUTES, "location", "representative_point")


def _ranges(spark: SparkSession, sf_dir: str, mode: str = "inclusive", **limits) -> range_ops.RangeTable:
    path = shared_folder(spark, f"ip_grid_{mode}/{sf_dir.strip('/').replace('/', '-')}")
    if path not in _BUILT:
        table = _built(spark, sf_dir, "ip_ranges", lambda: range_ops.ip_range_table(fx.raw_ranges(spark, sf_dir)))
        disjoint = range_ops.overlapping_ranges(table).isEmpty()
        table_builds.store_grid(range_ops.grid_cells(table, _RANGE_COLUMNS, mode, disjoint), path, disjoint)
        _BUILT.add(path)
    return table_builds.open_grid(spark, path, **limits)


@query
def geo_ip(spark, sf_dir):
    return range_ops.lookup_ip(fx.probe_ips(spark, sf_dir), "ip", _ranges(spark, sf_dir))


@query
def geo_ip_large(spark, sf_dir):
    """The same lookup by the way taken when the range table is too large to broadcast."""
    table = _ranges(spark, sf_dir, max_rows=0)
    return range_ops.lookup_ip(fx.probe_ips(spark, sf_dir), "ip", table)


@query
def geo_ip_overlap(spark, sf_dir):
    """Overlapping ranges, cut into disjoint ones: the lowest end answers."""
    ranges = range_ops.ip_range_table(fx.overlapping_ranges(spark, sf_dir))
    return range_ops.lookup_ip(fx.probe_ips(spark, sf_dir), "ip", range_ops.prepare_ranges(ranges))


@query
def geo_ip_fine(spark, sf_dir):
    """A stored grid of short ranges, read in place by its buckets as a large table is."""
    target = shared_folder(spark, f"fine_grid/{uuid.uuid4().hex}")
    ranges = range_ops.ip_range_table(fx.fine_ranges(spark, sf_dir))
    table_builds.store_grid(range_ops.grid_cells(ranges, _RANGE_COLUMNS, "inclusive", True), target)
    table = table_builds.open_grid(spark, target, max_rows=0)
    return range_ops.lookup_ip(fx.fine_probes(spark, sf_dir), "ip", table, int_ip=True)


@query
def geo_ip_compat(spark, sf_dir):
    return range_ops.lookup_ip(fx.probe_ips(spark, sf_dir), "ip", _ranges(spark, sf_dir, "compat"))


@query
def geo_ip_by_country(spark, sf_dir):
    located = range_ops.lookup_ip(
        fx.probe_ips(spark, sf_dir), "ip", _ranges(spark, sf_dir)
    )
    return located.groupBy("geo_country_code").agg(F.count(F.lit(1)).alias("events"))


@query
def cidr_join(spark, sf_dir):
    key = F.col("c_custkey")
    length = F.lit(12) + key % 13
    start = fx.hashed_address(key).bitwiseAND(ips.prefix_mask(length))
    cidr = F.concat(fx.dotted(start), F.lit("/"), length.cast("string"))
    networks = fx.table(spark, sf_dir, "customer").groupBy(cidr.alias("cidr")).agg(F.min("c_custkey").alias("network"))
    return range_ops.join_networks(fx.event_ips(spark, sf_dir), "ip", networks, int_ip=True)


# ---------------------------------------------------------------- place lookups


def _place_index(spark: SparkSession, sf_dir: str) -> place_ops.PlaceIndex:
    rows = _built(spark, sf_dir, "place_rows", lambda: place_ops.place_rows(fx.places(spark, sf_dir)))
    postings = _built(spark, sf_dir, "place_postings", lambda: place_ops.place_postings(rows))
    frequency = _built(spark, sf_dir, "term_frequency", lambda: place_ops.term_frequency(postings))
    answers = _built(spark, sf_dir, "term_answers", lambda: place_ops.term_answers(rows, postings))
    return place_ops.PlaceIndex(rows, postings, frequency, answers)


def _place_query(on: dict[str, str], op: str = "AND", scope: str = "first_token") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        index = _place_index(spark, sf_dir)
        return place_ops.lookup_place(fx.place_probes(spark, sf_dir), index, on, op, scope)

    return run


QUERIES["place_token"] = _place_query({"region_name": "area"})
QUERIES["place_any"] = _place_query({"": "town"})
QUERIES["place_and"] = _place_query({"place_name": "town", "country_code": "brand"}, scope="column")
QUERIES["place_or"] = _place_query({"place_name": "town", "country_code": "brand"}, "OR", "column")
QUERIES["place_not"] = _place_query({"place_name": "town", "region_name": "area"}, "NOT")
QUERIES["geo_place"] = _place_query({"place_name": "town", "region_name": "area"})


@query
def place_known(spark, sf_dir):
    """The lookup of ``geo_place`` in two batches; the second asks for what is known, and more."""
    probes = fx.place_probes(spark, sf_dir)
    store = AnswerStore(spark, shared_folder(spark, f"known_places/{uuid.uuid4().hex}"))
    index = replace(_place_index(spark, sf_dir), known=store)
    on = {"place_name": "town", "region_name": "area"}
    place_ops.lookup_place(probes.where("event_id % 2 = 0"), index, on)
    return place_ops.lookup_place(probes, index, on)


# ---------------------------------------------------------------- relay flags


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    relays = tor.relay_table(*fx.relay_ips(spark, sf_dir))
    e = F.col("event_id")
    text = F.when(e % 50 == 7, F.lit("")).when(e % 50 == 9, F.lit("1.2.3.x")).when(e % 50 != 11, fx.dotted(F.col("ip")))
    return tor.tag_relays(fx.event_ips(spark, sf_dir).withColumn("ip", text), "ip", relays)


@query
def tor_exit(spark, sf_dir):
    return _tagged(spark, sf_dir).select("event_id", "tor_is_exit_node")


@query
def tor_server(spark, sf_dir):
    return _tagged(spark, sf_dir).select("event_id", "tor_is_tor_server")


@query
def tor_label(spark, sf_dir):
    return _tagged(spark, sf_dir)


@query
def tor_missing(spark, sf_dir):
    return tor.missing_servers(*fx.relay_ips(spark, sf_dir))


# ---------------------------------------------------------------- documents and sinks


@query
def envelope(spark, sf_dir):
    parsed = parse.accepted(parse.parse_typed(fx.event_lines(spark, sf_dir), fx.LINE_CONFIG)).drop("ordinal")
    rows = documents.with_document_id(parsed, ["id", "kind"])
    return documents.to_documents(rows, "logs", "event", "_id")


def _identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value")
    return documents.with_document_id(events, ["event_type", "user_id"])


@query
def dedup_last(spark, sf_dir):
    return documents.latest_by_id(_identified(spark, sf_dir), ["event_id"])


@query
def upsert_merge(spark, sf_dir):
    rows = _identified(spark, sf_dir)
    current = documents.latest_by_id(rows.where("event_id % 3 > 0"), ["event_id"])
    return documents.merge_documents(current, rows.where("event_id % 3 = 0"), "event_id")


@query
def upsert_batches(spark, sf_dir):
    folder = shared_folder(spark, "upsert_batches")
    rows = _identified(spark, sf_dir)
    for batch in range(3):
        sinks.write_batch(rows.where(F.col("event_id") % 3 == batch), folder, batch)
    sinks.write_batch(rows.where("event_id % 3 = 1"), folder, 1)  # a retry replaces its batch
    return sinks.current_documents(spark, folder, order="event_id")


@query
def write_docs(spark, sf_dir):
    folder = shared_folder(spark, "write_docs")
    parsed = parse.accepted(parse.parse_untyped(fx.event_lines(spark, sf_dir), fx.LINE_CONFIG)).drop("ordinal")
    docs = documents.to_documents(parsed, "logs", "event")
    sinks.write_documents(docs.where(F.col("_source").contains("click")), folder, "json", replace=True, partitions=4, compression="gzip")
    sinks.write_documents(docs.where(~F.col("_source").contains("click")), folder, "json", compression="gzip")
    return spark.read.schema("_index string, _type string, _source string").json(folder)


@query
def noop_count(spark, sf_dir):
    """The dry run's count, beside one taken over the same plan."""
    rows = parse.accepted(parse.parse_typed(fx.event_lines(spark, sf_dir), fx.LINE_CONFIG))
    run = sinks.dry_run(rows)
    counted = rows.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.when(F.col("n") == run.rows, F.col("n")).alias("rows_read"))


# ---------------------------------------------------------------- whole imports


def _country_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(
        spark, sf_dir, "country_answers", lambda: key_answers(fx.points(spark, sf_dir), COUNTRY, COUNTRY.keys, every_subset=True)
    )


def _tables(spark: SparkSession, sf_dir: str) -> LookupTables:
    return LookupTables(
        ranges=_ranges(spark, sf_dir),
        relays=tor.relay_table(*fx.relay_ips(spark, sf_dir)),
    )


@query
def import_by_ip(spark, sf_dir):
    options = ImportOptions(
        typed=True, dates_in_seconds=True, geo_precision="ip", geo_columns={"ip": "ip"}, tor_column="ip",
        constants={"service": "web"}, md5_id=True, md5_exclude=["at"],
    )
    lines = fx.access_lines(spark, sf_dir)
    return import_lines(lines, fx.ACCESS_CONFIG, options, _tables(spark, sf_dir)).rows


@query
def import_by_country(spark, sf_dir):
    options = ImportOptions(
        dates_in_seconds=True, geo_precision="country_level", geo_columns={"country_code": "brand"},
        constants={"service": "web"},
    )
    lines = fx.access_lines(spark, sf_dir)
    tables = LookupTables(countries=_country_answers(spark, sf_dir))
    return import_documents(lines, fx.ACCESS_CONFIG, options, tables, keep=("ordinal",)).rows


@query
def import_by_place(spark, sf_dir):
    options = ImportOptions(geo_precision="multilevel", geo_columns={"place_name": "town", "region_name": "area"})
    tables = LookupTables(places=_place_index(spark, sf_dir))
    return import_lines(fx.place_lines(spark, sf_dir), fx.PLACE_CONFIG, options, tables).rows


@query
def import_report(spark, sf_dir):
    """One pass over the lines: what became of each, why, and which value did not parse."""
    folder = shared_folder(spark, f"import_report/{uuid.uuid4().hex}")
    options = ImportOptions(typed=True, constants={"service": "web"})
    done = write_import(fx.event_lines(spark, sf_dir), fx.LINE_CONFIG, options, folder)
    none = F.lit(None).cast("string")
    rows = done.rows().join(done.bad_fields().select("ordinal", "field"), "ordinal", "left").select(
        "ordinal", F.lit("row").alias("outcome"), none.alias("reason"), F.col("field").alias("bad_field"), "service"
    )
    rejected = done.rejects().select(
        "ordinal", F.lit("reject").alias("outcome"), "reason", none.alias("bad_field"), none.alias("service")
    )
    return rows.unionByName(rejected)


def _dropped_lines(spark: SparkSession, sf_dir: str) -> str:
    folder = shared_folder(spark, f"dropped_lines/{uuid.uuid4().hex}")
    fx.event_lines(spark, sf_dir).select("value").write.text(folder)
    return folder


@query
def stream_rejects(spark, sf_dir):
    """Rejected lines of a streamed import, with the counts its batches reported."""
    folder = _dropped_lines(spark, sf_dir)
    listener = LoadListener()
    stream = import_stream(
        stream_lines(spark, folder, max_files=4), fx.LINE_CONFIG, ImportOptions(typed=True), LookupTables(),
        f"{folder}_out", f"{folder}_state", once=True, report=listener.add,
    )
    stream.awaitTermination()
    kept = spark.read.parquet(f"{folder}_out_rejects").select("line", "reason")
    return kept.select("*", F.lit(listener.totals["failed"]).cast("bigint").alias("failed"))


@query
def stream_upsert(spark, sf_dir):
    """Two streamed runs into one store: the first is folded before the second, and retried after it."""
    folder = shared_folder(spark, f"stream_upsert/{uuid.uuid4().hex}")
    options = ImportOptions(md5_id=True, md5_exclude=["id", "at", "size"])

    def load(part: int, state: str) -> None:
        lines = fx.event_lines(spark, sf_dir).where(F.col("ordinal") % 2 == part)
        ordered = lines.repartitionByRange(4, "ordinal").sortWithinPartitions("ordinal").select("value")
        ordered.write.mode("ignore").text(f"{folder}/in{part}")
        stream = stream_lines(spark, f"{folder}/in{part}")
        import_stream(stream, fx.LINE_CONFIG, options, LookupTables(), f"{folder}/out", state, once=True).awaitTermination()

    load(0, f"{folder}/state0")
    sinks.fold(spark, f"{folder}/out")
    load(1, f"{folder}/state1")
    first = next(r for r, _ in sorted(sinks._batches(spark, f"{folder}/out")) if not r.startswith(sinks.SNAPSHOT))
    again = spark.read.parquet(f"{folder}/out/run={first}/batch_id=0")
    sinks.write_batch(stored(again.drop(sinks.SESSION), "retried"), f"{folder}/out", 0, run=first)
    sinks.fold(spark, f"{folder}/out")
    return sinks.current_documents(spark, f"{folder}/out").drop("_seq")


@query
def reject_collect(spark, sf_dir):
    parsed = parse.parse_typed(fx.event_lines(spark, sf_dir), fx.LINE_CONFIG)
    kept, rejects = parse.apply_reject_policy(parsed, "collect")
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n") for name, df in (("rows", kept), ("rejects", rejects))]
    return counted[0].unionByName(counted[1])


@query
def reject_fail(spark, sf_dir):
    """Lines without a reject pass; the first reject would end the job."""
    lines = fx.event_lines(spark, sf_dir).where("ordinal % 13 != 0")
    kept, _ = parse.apply_reject_policy(parse.parse_typed(lines, fx.LINE_CONFIG), "fail")
    return kept


def build_tables(spark: SparkSession, sf_dir: str) -> None:
    """Build the stored lookup tables that queries share, so that none of them pays for another's."""
    _place_index(spark, sf_dir)
    _country_answers(spark, sf_dir)
    for mode in ("inclusive", "compat"):
        _ranges(spark, sf_dir, mode)


for _name in ("scan_lines", "stream_lines", "load_report"):
    QUERIES[_name] = QUERIES.pop(_name + "_query")
