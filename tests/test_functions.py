import random
import socket
import struct

import pytest
from pyspark.sql import functions as F

from wayline.functions.casts import cast_text, is_nan_or_inf, seconds_text_to_ms, strip_right, to_float
from wayline.functions.ids import document_id
from wayline.functions.ip import in_network, int_to_ip, ip_to_int
from wayline.functions.text import coordinate_text, words

# Addresses, their integers, a network that holds them, one that does not.
PAIRS = [
    ("192.168.2.1", 3232236033, "192.168.2.0/24", "65.43.115.0/24"),
    ("83.112.12.2", 1399852034, "83.112.12.0/24", "172.14.12.0/24"),
    ("172.14.12.12", 2886601740, "172.14.12.0/24", "83.112.12.0/24"),
    ("65.43.115.255", 1093366783, "65.43.115.0/24", "192.168.2.0/24"),
]


def test_address_pairs(spark):
    df = spark.createDataFrame(PAIRS, "ip string, n bigint, inside string, outside string").select(
        "ip", "n", ip_to_int("ip").alias("to"), ip_to_int("ip", strict=True).alias("strict"), int_to_ip("n").alias("back"),
        in_network("n", F.col("inside")).alias("yes"), in_network("n", F.col("outside")).alias("no"),
    )
    for row in df.collect():
        assert (row.to, row.strict, row.back, row.yes, row.no) == (row.n, row.n, row.ip, True, False)


def test_address_grammar_is_that_of_the_c_library(spark):
    cases = [
        "1.2.3", "1.2", "7", "0x10.1", "010.1.1.1", "08.1.1.1", "1.2.3.4 foo", " 1.2.3.4", "", "1..2", "1.2.3.4.5",
        "4294967295", "4294967296", "0xffffffff", "0xfffffffff", "1.16777215", "1.16777216", "1.2.65535", "1.2.65536",
        "0", "00", "0x", "256.1.1.1", "1.2.3.4\n", "1.2.3.4x", "9" * 30, "0x" + "f" * 30, "037777777777", "040000000000",
        "1.2.3.0377", "1.2.3.0400", "1.2.3.", ".1.2.3", "-1.2.3.4", "a",
    ]
    rng = random.Random(5)
    cases += ["".join(rng.choice("0123456789.xa ") for _ in range(rng.randint(1, 9))) for _ in range(1500)]
    cases += [
        ".".join(rng.choice(["%d", "0x%x", "0%o"]) % rng.choice([rng.randint(0, 300), rng.randint(0, 2**33)])
                 for _ in range(rng.randint(1, 5)))
        for _ in range(800)
    ]

    def expected(text):
        try:
            return struct.unpack("!I", socket.inet_aton(text))[0]
        except OSError:
            return None

    df = spark.createDataFrame([(c,) for c in cases], "t string").select("t", ip_to_int("t").alias("v"))
    assert [(r.t, r.v) for r in df.collect() if r.v != expected(r.t)] == []


def test_int_to_ip_range(spark):
    df = spark.createDataFrame([(0,), (4294967295,), (4294967296,), (-1,), (None,)], "n bigint")
    assert [r[0] for r in df.select(int_to_ip("n")).collect()] == ["0.0.0.0", "255.255.255.255", None, None, None]


def test_network_with_host_bits_is_empty(spark):
    df = spark.createDataFrame([(3232236033,)], "n bigint")
    assert df.select(in_network("n", "192.168.2.1/24")).first()[0] is False
    assert df.select(in_network("n", "0.0.0.0/0")).first()[0] is True
    assert df.select(in_network("n", "192.168.2.1/32")).first()[0] is True


# Text, declared type, parsed value with dates in seconds.
PARSED = [
    ("", "float", None), ("+inf", "float", None), ("inf", "integer", None), ("1.1", "float", 1.1), ("1", "long", 1),
    ("1", "integer", 1), ("1", "string", "1"), ("1519995883.3099031", "date", 1519995883309),
    ("1.9", "integer", 1), ("-1.9", "integer", -1), ("3e9", "integer", None), ("3e9", "long", 3000000000),
    ("true", "boolean", "true"), ("x", "float", None), (None, "float", None),
]


@pytest.mark.parametrize("text,declared,expected", PARSED)
def test_typed_values(spark, text, declared, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(cast_text(F.col("t"), declared, dates_in_seconds=True)).first()[0] == expected


def test_exact_long(spark):
    df = spark.createDataFrame([("9007199254740993",)], "t string")
    row = df.select(cast_text(F.col("t"), "long"), cast_text(F.col("t"), "long", exact_long=True)).first()
    assert tuple(row) == (9007199254740992, 9007199254740993)


def test_numbers_follow_python(spark):
    cases = ["1", "1.", ".5", ".", "", " 1 ", "\t2\n", "1d", "1.0f", "0x10", "1_000", "1__0", "_1", "1_", "1e5", "1E-3",
             "1e", "1e1_0", "+1", "-1", "--1", "1 2", "inf", "-Infinity", "nan", "NaN", "1e400", "\xa07", "1,5", "0" * 40]

    def expected(text):
        try:
            return repr(float(text))
        except ValueError:
            return None

    df = spark.createDataFrame([(c,) for c in cases], "t string").select("t", to_float(F.col("t")).alias("v"))
    got = {r.t: None if r.v is None else repr(r.v) for r in df.collect()}
    assert got == {c: expected(c) for c in cases}


def test_not_finite(spark):
    values = [float("inf"), float("-inf"), float("nan"), 0.0, 0.2, 200.0, 25.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(is_nan_or_inf(F.col("v")))
    assert [r[0] for r in df.collect()] == [True, True, True, False, False, False, False, None]


def test_strip_right_follows_python(spark):
    cases = ["a ", "a\t\r\n", "a b", " a\x1c\x85\xa0   ", "", "  ", "é "]
    df = spark.createDataFrame([(c,) for c in cases], "t string").select(strip_right(F.col("t")))
    assert [r[0] for r in df.collect()] == [c.rstrip() for c in cases]


def test_seconds_text(spark):
    df = spark.createDataFrame([("1519995883",), ("1519995883.33",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(seconds_text_to_ms(F.col("t"))).collect()]
    assert got == ["1519995883000", "1519995883330", None, "000"]


def test_coordinate_text_follows_python(spark):
    values = [0.0, 1.0, -3.74922, 40.463667, 0.001, 0.0005, -0.00012345, 0.0001, 0.00005, -1.5e-05, 1e-10, 1.25e-12,
              179.75, 1.6015540000000001, -0.0009999]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(coordinate_text(F.col("v")))
    assert [r[0] for r in df.collect()] == [str(v) for v in values]


def test_words(spark):
    df = spark.createDataFrame([("Île-de-France, 2e",), ("São  Tomé_x",), ("--",), (None,)], "t string")
    got = [r[0] for r in df.select(words(F.col("t"))).collect()]
    assert got == [["ile", "de", "france", "2e"], ["sao", "tome", "x"], [], []]


def test_document_id_does_not_depend_on_partitions(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 > 0, "x").alias("t"))
    ids = [{r.id: r.h for r in df.repartition(n).select("id", document_id(["t", "id"]).alias("h")).collect()} for n in (1, 7)]
    assert ids[0] == ids[1] and len(set(ids[0].values())) == 1000
    with pytest.raises(ValueError):
        document_id(["a"], ["a"])


def test_line_separators_are_no_end_of_text(spark):
    rows = spark.createDataFrame([(f"1.2.3.4{c}",) for c in ("\x85", "\u2028", "\u2029")] + [("1.2.3.4",)], "t string")
    from wayline.functions.ip import ip_to_int

    assert [r[0] for r in rows.select(ip_to_int(F.col("t"))).collect()] == [None, None, None, 16909060]


def test_negative_zero_keeps_its_sign(spark):
    from wayline.functions.casts import finite

    rows = spark.createDataFrame([("-0.0",), ("0.0",), ("-0",)], "t string")
    assert [str(r[0]) for r in rows.select(finite(F.col("t"))).collect()] == ["-0.0", "0.0", "-0.0"]
