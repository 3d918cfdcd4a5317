"""Inputs that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.config import ImportConfig

ADDRESSES = 4294967296

LINE_CONFIG = ImportConfig(
    "logs", "event",
    {"id": "long", "at": "date", "size": "float", "kind": "keyword"},
    ("id", "at", "size", "kind"),
)

ACCESS_CONFIG = ImportConfig(
    "access", "hit",
    {"at": "date", "ip": "ip", "brand": "keyword", "kind": "keyword", "size": "float"},
    ("at", "ip", "brand", "kind", "size"),
)

PLACE_CONFIG = ImportConfig("visits", "hit", {"town": "keyword", "area": "keyword"}, ("town", "area"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quarter_degrees(key: Column) -> list[Column]:
    """A point on a quarter-degree grid, exact in binary."""
    lat = F.pmod(key * 37, F.lit(720)) * F.lit(0.25) - 90
    lon = F.pmod(key * 53, F.lit(1440)) * F.lit(0.25) - 180
    return [lat.alias("latitude"), lon.alias("longitude")]


def hashed_address(key: Column) -> Column:
    return F.pmod(F.pmod(key, F.lit(2147483648)) * 2654435761, F.lit(ADDRESSES))


def dotted(ip: Column) -> Column:
    return F.concat_ws(".", *[F.shiftright(ip, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)])


def event_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an address."""
    return table(spark, sf_dir, "events").select("event_id", hashed_address(F.col("event_id")).alias("ip"))


def raw_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address ranges from customers: equal widths, a gap after every fifth, and every
    seventh stored twice with another point."""
    customers = table(spark, sf_dir, "customer")
    width = F.call_function("div", F.lit(ADDRESSES), customers.agg(F.count(F.lit(1))).scalar())
    last = customers.agg(F.max("c_custkey")).scalar()
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    end = F.when(key == last, F.lit(ADDRESSES - 1)).otherwise((key + 1) * width - 1)
    copies = F.when(key % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    lat, lon = quarter_degrees(key + F.col("copy") * 11)
    return (
        customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .withColumn("copy", F.explode(copies))
        .select(
            (key * width).alias("ip_from"),
            (end - F.when(key % 5 == 0, 1000).otherwise(0)).alias("ip_to"),
            F.upper("n_name").alias("country_code"),
            F.upper("c_mktsegment").alias("country_name"),
            F.upper("c_name").alias("region_name"),
            F.concat(F.lit("PLACE "), (key % 97).cast("string")).alias("place_name"),
            lat, lon,
            key.cast("string").alias("zip_code"),
            (key * 2 + F.col("copy")).alias("row_id"),
        )
    )


def _sized_ranges(spark: SparkSession, sf_dir: str, start: Column, end: Column) -> DataFrame:
    """Address ranges from customers; ``key`` and ``width``, a customer's share, may be used."""
    customers = table(spark, sf_dir, "customer")
    width = F.call_function("div", F.lit(ADDRESSES), customers.agg(F.count(F.lit(1))).scalar())
    lat, lon = quarter_degrees(F.col("key"))
    keyed = customers.select(F.col("c_custkey").alias("key"), "c_name", "c_mktsegment", width.alias("width"))
    return keyed.select(
        start.cast("bigint").alias("ip_from"), end.cast("bigint").alias("ip_to"),
        F.upper("c_name").alias("country_code"), F.upper("c_mktsegment").alias("country_name"),
        F.lit("R").alias("region_name"), F.concat(F.lit("PLACE "), (F.col("key") % 97).cast("string")).alias("place_name"),
        lat, lon, F.col("key").cast("string").alias("zip_code"), F.col("key").alias("row_id"),
    ).where(F.col("ip_to") < ADDRESSES)


def overlapping_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested and crossing ranges of one to seven shares, no two with the same end; each
    hundredth begins at address 0."""
    key, width = F.col("key"), F.col("width")
    start = F.when(key % 100 == 0, F.lit(0)).otherwise(F.greatest(F.lit(0), key - key % 4) * width + key % 5 * 100)
    return _sized_ranges(spark, sf_dir, start, (key + 1 + key % 4) * width - 1 - key % 1000)


def fine_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disjoint ranges of 1 to 65,536 addresses, far apart."""
    key, width = F.col("key"), F.col("width")
    length = F.least(F.call_function("shiftleft", F.lit(1).cast("bigint"), (key % 17).cast("int")), F.expr("width div 2"))
    start = key * width + key % 1000
    return _sized_ranges(spark, sf_dir, start, start + length - 1)


def fine_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses from events, about half of them in a range of :func:`fine_ranges`."""
    customers = table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    width = F.call_function("div", F.lit(ADDRESSES), customers)
    key = F.pmod(F.col("event_id"), customers)
    offset = F.pmod(F.col("event_id") * 7919, F.call_function("shiftleft", F.lit(2).cast("bigint"), (key % 17).cast("int")))
    ip = F.least(key * width + key % 1000 + offset, F.lit(ADDRESSES - 1))
    return table(spark, sf_dir, "events").select("event_id", ip.alias("ip"))


def probe_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address texts from events: hashed ones, exact range ends, bad texts and nulls."""
    customers = table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    width = F.call_function("div", F.lit(ADDRESSES), customers)
    key = F.pmod(F.col("event_id"), customers)
    end = F.least((key + 1) * width - 1, F.lit(ADDRESSES - 1)) - F.when(key % 5 == 0, 1000).otherwise(0)
    ip = F.when(F.col("event_id") % 10 == 0, end).otherwise(hashed_address(F.col("event_id")))
    text = F.when(F.col("event_id") % 97 == 0, F.lit("not an address")).when(
        F.col("event_id") % 89 != 0, dotted(ip)
    )
    return table(spark, sf_dir, "events").select("event_id", "event_type", text.alias("ip"))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited lines from events, some short, some with too many fields or bad numbers."""
    e = F.col("event_id")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    ms = F.timestamp_diff("MILLISECOND", epoch, F.col("ts").cast("timestamp_ntz"))
    value = F.col("value").cast("string")
    size = (
        F.when(e % 19 == 0, F.lit("abc")).when(e % 7 == 0, F.lit("nan")).when(e % 11 == 0, F.lit(""))
        .when(e % 23 == 0, F.concat(value, F.lit("d"))).when(e % 29 == 0, F.lit("1_000"))
        .when(e % 31 == 0, F.concat(F.lit(" "), value, F.lit(" "))).otherwise(value)
    )
    line = F.concat(
        e.cast("string"), F.lit(";"), ms.cast("string"), F.lit(";"), size,
        F.when(e % 17 == 0, F.lit("")).otherwise(F.concat(F.lit(";"), F.col("event_type"))),
        F.when(e % 13 == 0, F.lit(";x;y")).otherwise(F.lit("")),
        F.when(e % 3 == 0, F.lit(" \t")).otherwise(F.lit("")),
    )
    return table(spark, sf_dir, "events").select(e.alias("ordinal"), line.alias("value"))


def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited access-log lines from events: time in seconds, address, brand, kind, size."""
    e = F.col("event_id")
    line = F.concat_ws(
        ";", (e + 1700000000).cast("string"), F.coalesce("ip", F.lit("")),
        F.concat(F.lit("Brand#"), (e % 30).cast("string")), F.col("event_type"), (e % 1000 / 4).cast("string"),
    )
    return probe_ips(spark, sf_dir).select(e.alias("ordinal"), line.alias("value"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a keyed point table."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        *quarter_degrees(key),
        F.upper("p_brand").alias("country_code"),
        F.upper("p_type").alias("country_name"),
        key.alias("row_id"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a place table."""
    key = F.col("p_partkey")
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "part").select(
        F.upper("p_brand").alias("country_code"),
        key.cast("string").alias("zip_code"),
        F.upper("p_name").alias("place_name"),
        F.upper("p_type").alias("admin_name1"),
        F.concat(F.lit("A"), (key % 50).cast("string")).alias("admin_code1"),
        none.alias("admin_name2"), none.alias("admin_code2"),
        none.alias("admin_name3"), none.alias("admin_code3"),
        *quarter_degrees(key),
        F.col("p_size").cast("double").alias("accuracy"),
        key.alias("row_id"),
    )


def place_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place queries from events: names as stored, in capitals, single words, unknown
    words, and nulls."""
    e = F.col("event_id")
    parts = table(spark, sf_dir, "part")
    n = parts.agg(F.count(F.lit(1))).scalar()
    named = table(spark, sf_dir, "events").select("event_id", F.pmod(e, n).alias("p_partkey")).join(
        parts.select("p_partkey", "p_name", "p_type", "p_brand"), "p_partkey"
    )
    return named.select(
        "event_id",
        F.when(e % 11 == 0, F.lit(None)).when(e % 7 == 0, F.upper("p_name"))
        .when(e % 5 == 0, F.split("p_name", " ").getItem(0)).when(e % 13 == 0, F.lit("Atlantis"))
        .otherwise(F.col("p_name")).alias("town"),
        F.when(e % 3 == 0, F.lit(None)).otherwise(F.lower("p_type")).alias("area"),
        F.col("p_brand").alias("brand"),
    )


def place_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place queries as delimited lines; a null is an empty field."""
    fields = [F.coalesce(c, F.lit("")) for c in ("town", "area")]
    return place_probes(spark, sf_dir).select(F.col("event_id").alias("ordinal"), F.concat_ws(";", *fields).alias("value"))


def relay_ips(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Exit and server address sets; some exits are not servers."""
    ips = event_ips(spark, sf_dir)
    exits = ips.where("event_id % 50 = 0").select(F.col("ip").alias("ip_int"))
    servers = ips.where("event_id % 20 = 0").select(F.col("ip").alias("ip_int"))
    return exits.distinct(), servers.distinct()
