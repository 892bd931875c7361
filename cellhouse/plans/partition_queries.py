"""Queries over the keyed partition operators: U1-U4 and A1."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bytes import int_key, padded_key
from ..functions.regions import region_index, table_starts
from ..operators.partitions import (foreach_committed, group_values, map_bundles, map_partitions,
                                    map_partitions_unkeyed)
from ..session import new_path
from .fixtures import cents, key_splits, sql_key, sql_order_region, tbl
from .registry import register

def _region(spark, d):
    return region_index(F.col("row"), table_starts(key_splits(spark, d)), presorted=True)


def _lines(spark, d):
    l = tbl(spark, d, "lineitem")
    return l.select(padded_key("l_orderkey").alias("row"), "l_linenumber", "l_partkey", "l_suppkey",
                    cents("l_extendedprice").alias("cents"))


@register("group_by_key", f"""
SELECT {sql_key('l_orderkey')} AS row, count(*) AS n_lines,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total_cents,
       min(l_linenumber) AS min_line, max(l_linenumber) AS max_line
FROM lineitem GROUP BY 1
""")
def q_group_by_key(spark, d):
    # A1 as a partial + final aggregate: no group is ever held as a list
    g = _lines(spark, d).groupBy("row").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("cents").alias("total_cents"),
        F.min("l_linenumber").alias("min_line"), F.max("l_linenumber").alias("max_line"))
    return g.select(F.decode("row", "UTF-8").alias("row"), "n_lines", "total_cents", "min_line", "max_line")


VALUES = T.StructType([
    T.StructField("l_linenumber", T.IntegerType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("cents", T.LongType()),
])


@register("group_values", f"""
SELECT {sql_key('l_orderkey')} AS key, row_number() OVER (PARTITION BY l_orderkey
         ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) - 1 AS "index",
       l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem
""")
def q_group_values(spark, d):
    # A1: each key with its values in order; no list of a group exists
    out = group_values(_lines(spark, d), "row", VALUES, order_by=("l_linenumber", "l_partkey", "l_suppkey", "cents"))
    return out.select(F.decode("key", "UTF-8").alias("key"), "index", *[f.name for f in VALUES.fields])


# --- U2: keyed map with a per-group Python function -------------------------
RUNNING = T.StructType([
    T.StructField("l_linenumber", T.IntegerType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("running_cents", T.LongType()),
])


def running_total(conf, key, batches):
    """Lines of one order, arriving in (line, part, supplier, cents) order,
    with a running sum -- one pass, batch by batch (the group is never
    collected)."""
    carry = 0
    for b in batches:
        run = pc.add(pc.cumulative_sum(b.column("cents")), carry)
        if len(run):
            carry = run[-1].as_py()
        yield pa.RecordBatch.from_arrays(
            [b.column("l_linenumber"), b.column("l_partkey"), b.column("l_suppkey"), run],
            names=[f.name for f in RUNNING.fields])


@register("map_partitions", f"""
SELECT {sql_key('l_orderkey')} AS key,
       row_number() OVER w - 1 AS "index", l_linenumber, l_partkey, l_suppkey,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS running_cents
FROM lineitem
WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
             CAST(round(l_extendedprice * 100) AS BIGINT))
""")
def q_map_partitions(spark, d):
    out = map_partitions(_lines(spark, d), "row", running_total, RUNNING,
                         order_by=("l_linenumber", "l_partkey", "l_suppkey", "cents"))
    return out.select(F.decode("key", "UTF-8").alias("key"), "index", "l_linenumber", "l_partkey", "l_suppkey",
                      "running_cents")


# --- U2 and A1 with a key that holds a third of all rows ----------------------
SQL_HOT = "CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END"


def _hot_lines(spark, d):
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey"))
    return tbl(spark, d, "lineitem").select(
        hot.alias("hot"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents("l_extendedprice").alias("cents"))


HOT_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents")
SQL_HOT_ORDER = "ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)"
SUM = T.StructType([T.StructField("cents", T.LongType())])
SCANNED = T.StructType([T.StructField("l_orderkey", T.LongType()), *RUNNING.fields])


def total_of(conf, key, batches):
    """What a running sum must know of the rows before it."""
    return (sum(pc.sum(b.column("cents")).as_py() or 0 for b in batches),)


def add_totals(conf, key, a, b):
    return (a[0] + b[0],)


def running_total_from(conf, key, batches, state):
    sofar = state[0] if state else 0
    for b in batches:
        run = pc.add(pc.cumulative_sum(b.column("cents")), sofar)
        sofar = run[-1].as_py() if len(run) else sofar
        yield pa.RecordBatch.from_arrays(
            [*(b.column(n) for n in HOT_ORDER[:4]), run], names=[f.name for f in SCANNED.fields])


@register("map_partitions_hot_key", f"""
SELECT {SQL_HOT} AS key, row_number() OVER w - 1 AS "index", l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS running_cents
FROM lineitem WINDOW w AS (PARTITION BY {SQL_HOT} {SQL_HOT_ORDER})
""")
def q_map_partitions_hot_key(spark, d):
    # a third of all lines under one key: its run is cut into ranges that run side by side
    return map_partitions(_hot_lines(spark, d), "hot", running_total_from, SCANNED, order_by=HOT_ORDER,
                          carry=total_of, combine=add_totals, carry_schema=SUM)


@register("group_values_hot_key", f"""
SELECT {SQL_HOT} AS key, row_number() OVER (PARTITION BY {SQL_HOT} {SQL_HOT_ORDER}) - 1 AS "index",
       l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem
""")
def q_group_values_hot_key(spark, d):
    return group_values(_hot_lines(spark, d), "hot", VALUES, order_by=HOT_ORDER)


# --- U3: unkeyed, one group per Spark partition (no shuffle) -----------------
CENTS = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_partkey", T.LongType()), T.StructField("l_suppkey", T.LongType()),
    T.StructField("net_cents", T.LongType()),
])


def net_cents(conf, key, batches):
    for b in batches:
        net = pc.multiply(pc.multiply(b.column("l_extendedprice"), pc.subtract(1.0, b.column("l_discount"))), 100.0)
        net = pc.cast(pc.round(net, 0, round_mode="half_towards_infinity"), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column("l_orderkey"), b.column("l_linenumber"), b.column("l_partkey"), b.column("l_suppkey"), net],
            names=[f.name for f in CENTS.fields])


@register("map_partitions_unkeyed", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(round(l_extendedprice * (1.0 - l_discount) * 100.0) AS BIGINT) AS net_cents FROM lineitem
""")
def q_map_partitions_unkeyed(spark, d):
    l = tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                                         "l_discount")
    return map_partitions_unkeyed(l, net_cents, CENTS)


# --- U4: keyed by region, with pre-aggregation before the shuffle -------------
SUMMARY = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("total_cents", T.LongType()),
    T.StructField("min_row", T.BinaryType()), T.StructField("max_row", T.BinaryType()),
])
PARTIAL = SUMMARY


def _fold(batches, n_col, sum_col, lo_col, hi_col):
    """Single pass over a group: count, sum, min and max row."""
    n, tot, lo, hi = 0, 0, None, None
    for b in batches:
        if b.num_rows == 0:
            continue
        n += pc.sum(b.column(n_col)).as_py() if n_col else b.num_rows
        tot += pc.sum(b.column(sum_col)).as_py() or 0
        mn = pc.min(b.column(lo_col)).as_py()
        mx = pc.max(b.column(hi_col)).as_py()
        lo = mn if lo is None or mn < lo else lo
        hi = mx if hi is None or mx > hi else hi
    return [(int(n), int(tot), lo, hi)] if n else []


def region_partial(conf, key, batches):
    return _fold(batches, None, "cents", "row", "row")


def region_final(conf, key, batches):
    return _fold(batches, "n", "total_cents", "min_row", "max_row")


@register("map_partitions_by_region", f"""
SELECT right(lpad(hex(CAST(region AS BIGINT)), 16, '0'), 8) AS key_hex, count(*) AS n,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total_cents,
       min(row) AS min_row, max(row) AS max_row
FROM (SELECT {sql_key('l_orderkey')} AS row, {sql_order_region('l_orderkey')} AS region,
             l_extendedprice FROM lineitem)
GROUP BY region
""")
def q_map_partitions_by_region(spark, d):
    rows = _lines(spark, d).select("row", "cents")
    key = int_key(_region(spark, d))
    out = map_partitions(rows, key, region_final, SUMMARY, partial=region_partial, partial_schema=PARTIAL)
    return out.select(F.hex("key").alias("key_hex"), "n", "total_cents", F.decode("min_row", "UTF-8").alias("min_row"),
                      F.decode("max_row", "UTF-8").alias("max_row"))


# --- U1: keyed for-each whose side effects count once ---------------------------
def write_summary(conf, key, batches):
    """Side effect: one parquet file per key, in a folder of the task attempt."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    n, tot = 0, 0
    for b in batches:
        n += pc.sum(b.column("n")).as_py()
        tot += pc.sum(b.column("total_cents")).as_py()
    out = pa.table({"region": pa.array([key], pa.int64()), "n": [n], "total_cents": [tot]})
    fs, base = pafs.FileSystem.from_uri(f"{conf['out']}/{conf['attempt']}")
    fs.create_dir(base, recursive=True)
    pq.write_table(out, f"{base}/region-{key}.parquet", filesystem=fs)


def name_attempts(conf, attempts):
    """The attempts that count, as a table beside their folders."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    fs, base = pafs.FileSystem.from_uri(f"{conf['out']}-done")
    fs.create_dir(base, recursive=True)
    pq.write_table(pa.table({"attempt": attempts}), f"{base}/attempts.parquet", filesystem=fs)


@register("foreach_partition", f"""
SELECT CAST(region AS BIGINT) AS region, count(*) AS n,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM (SELECT {sql_order_region('l_orderkey')} AS region, l_extendedprice FROM lineitem)
GROUP BY region
""")
def q_foreach_partition(spark, d):
    out = new_path(spark, "foreach")
    uri = out if "://" in out or out.startswith("file:") else f"file://{out}"
    rows = _lines(spark, d).select("row", "cents")

    # regions are few and large: rows are folded inside each input partition first
    foreach_committed(rows, _region(spark, d), write_summary, name_attempts, conf={"out": uri}, partial=region_partial,
                      partial_schema=PARTIAL)
    done = spark.read.parquet(f"{uri}-done")
    files = spark.read.parquet(f"{uri}/*").withColumn("attempt", F.element_at(F.split("_metadata.file_path", "/"), -2))
    return files.join(F.broadcast(done), "attempt", "left_semi").select("region", "n", "total_cents")


# --- U3 by bundles ------------------------------------------------------------
BUNDLE = T.StructType([T.StructField("n", T.LongType()), T.StructField("bytes", T.LongType()),
                       T.StructField("cents", T.LongType())])
BUNDLE_ROWS, BUNDLE_BYTES = 500, 8192


def bundle_totals(conf, bundle, batches):
    n = size = total = 0
    for b in batches:
        n, size, total = n + b.num_rows, size + b.nbytes, total + (pc.sum(b.column("cents")).as_py() or 0)
    return [(n, size, total)]


@register("map_bundles", f"""
SELECT count(*) AS n_rows, CAST(sum(round(value * 100)) AS BIGINT) AS total_cents, true AS bounded,
       true AS enough, true AS distinct_ids FROM events
""")
def q_map_bundles(spark, d):
    rows = tbl(spark, d, "events").select("event_id", "user_id", cents("value").alias("cents"))
    out = map_bundles(rows, bundle_totals, BUNDLE, max_rows=BUNDLE_ROWS, max_bytes=BUNDLE_BYTES)
    return out.agg(F.sum("n").alias("n_rows"), F.sum("cents").alias("total_cents"),
                   ((F.max("n") <= BUNDLE_ROWS) & (F.max("bytes") <= BUNDLE_BYTES)).alias("bounded"),
                   (F.count("*") * BUNDLE_ROWS >= F.sum("n")).alias("enough"),
                   (F.count_distinct("bundle") == F.count("*")).alias("distinct_ids"))
