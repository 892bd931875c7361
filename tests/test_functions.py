"""F1-F15 scalar functions, including the edge rows of FIXTURES C."""

import bisect

import pytest
from pyspark.sql import functions as F

from cellhouse.functions.bytes import epoch_millis, int_key
from cellhouse.functions.regions import region_index, regions_for_range, sort_starts, table_starts
from cellhouse.functions.text import (java_split, kv_format, multi_cells_row, parse_cells, parse_kv,
                                      parse_multi_cells, split_lines)


def _java_split(s):
    # what String.split(" ") returns: trailing empty strings removed
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


SPLIT_CASES = ["", "   ", " a", "a  b  ", "a\tb", "a b c", "a b c d e", "aaa0 v[0]"]


def test_java_split_edges(spark):
    df = spark.createDataFrame([(s,) for s in SPLIT_CASES], "line string")
    got = {r.line: list(r.t) for r in df.select("line", java_split("line").alias("t")).collect()}
    for s in SPLIT_CASES:
        assert got[s] == _java_split(s), s


def test_split_lines(spark):
    df = spark.createDataFrame([("a\nb\r\nc\rd",), ("",), ("x",)], "text string")
    got = sorted(tuple(r.l) for r in df.select(split_lines("text").alias("l")).collect())
    assert got == sorted([("a", "b", "c", "d"), ("",), ("x",)])


def test_parsers(spark):
    df = spark.createDataFrame([("aaa0 fam0 qualifier v[0]",), ("bad line",), ("aaa1 v[1]",),
                                ("r f q0 v0 q1 v1",), ("r f q0 v0 q1",)], "line string")
    c = df.select(parse_cells("line", F.lit(7)).alias("c")).where("c is not null").collect()
    assert len(c) == 1 and bytes(c[0].c.row) == b"aaa0" and c[0].c.family == "fam0" and c[0].c.ts == 7
    kv = df.select(parse_kv("line", "f", "q", F.lit(1)).alias("c")).where("c is not null").collect()
    assert sorted(bytes(r.c.row) for r in kv) == [b"aaa1", b"bad"]
    m = df.select(multi_cells_row("line").alias("row"), F.size(parse_multi_cells("line", 2, F.lit(0))).alias("n"))
    got = sorted((bytes(r.row), r.n) for r in m.collect())
    # only the 6-token line is accepted; the row key is token 0 either way
    assert got == [(b"aaa0", 0), (b"aaa1", 0), (b"bad", 0), (b"r", 0), (b"r", 2)]


def test_kv_format(spark):
    r = spark.range(1).select(kv_format(F.lit("w"), F.lit(3)).alias("x")).first()
    assert r.x == "w:3"


ROW_BYTES = [b"", b"\x00", b"\x7f", b"\x80", b"\xff", b"aaa", b"aaa0", b"aab", b"bbb", b"bbb9", b"zz"]


@pytest.mark.parametrize("starts", [[b"", b"aaa", b"bbb"], [b"aaa", b"bbb"], [b"\x80"], []])
def test_region_index_matches_bisect(spark, starts):
    df = spark.createDataFrame([(bytearray(b),) for b in ROW_BYTES] + [(None,)], "row binary")
    got = {None if r.row is None else bytes(r.row): r.region
           for r in df.select("row", region_index("row", starts).alias("region")).collect()}
    s = sorted(starts)
    for b in ROW_BYTES:
        assert got[b] == bisect.bisect_right(s, b) - 1, (starts, b)
    assert got[None] is None


def test_region_index_many_starts_uses_bisect(spark):
    starts = [f"k{i:05d}".encode() for i in range(0, 3000, 3)]  # 1000 starts > tree limit
    rows = [f"k{i:05d}".encode() for i in range(0, 3000, 7)] + [b"a", b"z"]
    df = spark.createDataFrame([(bytearray(b),) for b in rows], "row binary")
    got = {bytes(r.row): r.region for r in df.select("row", region_index("row", starts).alias("region")).collect()}
    for b in rows:
        assert got[b] == bisect.bisect_right(starts, b) - 1


def test_sort_starts_keeps_input():
    keys = [b"\xff", b"\x00", b"\x80", b"a"]
    before = list(keys)
    assert sort_starts(keys) == [b"\x00", b"a", b"\x80", b"\xff"]  # unsigned byte order
    assert keys == before
    assert table_starts(["bbb", "aaa"]) == [b"", b"aaa", b"bbb"]


def test_regions_for_range():
    s = [b"", b"aaa", b"bbb"]
    assert regions_for_range(s, b"aab", b"bbc") == (1, 2)
    assert regions_for_range(s, None, b"aaa") == (0, 0)
    assert regions_for_range(s, b"bbb", None) == (2, 2)


def test_int_key(spark):
    df = spark.createDataFrame([(0,), (1,), (-1,), (-7500,), (2 ** 31 - 1,)], "i int")
    got = {r.i: r.h for r in df.select("i", F.hex(int_key("i")).alias("h")).collect()}
    assert got == {0: "00000000", 1: "00000001", -1: "FFFFFFFF", -7500: "FFFFE2B4", 2 ** 31 - 1: "7FFFFFFF"}


def test_epoch_millis_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-01 12:00:00.123456' AS t")
        assert df.select(epoch_millis("t").alias("m")).first().m == 1719835200123
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
