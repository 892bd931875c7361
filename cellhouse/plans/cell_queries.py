"""Queries over cell tables built from the supplied data: S5-S13, A4-A7,
J1-J4, O1, O3, O4, P2-P7, W1-W3."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from ..functions.bytes import epoch_millis, from_bytes, padded_key, text_key
from ..model import DELETE_FAMILY, DELETE_VERSION, PUT
from ..operators.aggregate import cell_presence_count, table_row_count, wide_rows
from ..operators.load import bulk_load, bulk_load_thin_rows, publish_staged, stage
from ..operators.lookup import bulk_get, bulk_get_cells, bulk_get_exists, bulk_get_missing, bulk_get_rows
from ..operators.maintain import compact, live_groups, set_family_options
from ..operators.mutate import apply_mutations, bulk_delete, bulk_put
from ..operators.sort import file_order_violations, rows_in_order
from ..operators.visibility import collapse_identical
from ..session import new_path
from ..sources.table import read_table
from ..sources.text import write_lines
from .fixtures import (EVENT_FAMILIES, EVENT_SPLITS, MISS_SHIFT, ORDER_FAMILIES, SQL_CUSTOMER_CELLS,
                       SQL_EVENT_CELLS, SQL_ORDER_CELLS, T_DEL, T_FUTURE, cents, customer_cells, decoded,
                       event_cells, key_splits, new_table, order_cells, sql_key, sql_order_region, tbl,
                       thin_line_cells, thin_line_row)
from .registry import register
from .text_queries import SQL_KV_CELLS, cell_line, kv_cells

def order_table(spark, d, name="orders", loads=1):
    t = new_table(spark, name, ORDER_FAMILIES, key_splits(spark, d))
    cells = order_cells(tbl(spark, d, "orders"))
    if loads == 1:
        bulk_load(t, cells)
    else:
        for i in range(loads):
            bulk_load(t, cells.where(F.col("seq") % loads == i))
    return t


def event_table(spark, d, name="events"):
    t = new_table(spark, name, EVENT_FAMILIES, EVENT_SPLITS)
    bulk_put(t, event_cells(tbl(spark, d, "events")))
    return t


def customer_table(spark, d):
    t = new_table(spark, "customers", ["info"], key_splits(spark, d, "customer", "c_custkey"))
    bulk_load(t, customer_cells(tbl(spark, d, "customer")))
    return t


SQL_SCAN_ORDERS = f"SELECT row, family, qualifier, ts, value FROM ({SQL_ORDER_CELLS})"


def _newest(src: str, extra_order: str = "seq DESC", n: int = 1) -> str:
    return f"""
SELECT row, family, qualifier, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY row, family, qualifier ORDER BY ts DESC, {extra_order}) AS rn
  FROM ({src})) WHERE rn <= {n}
"""


# --- loads and scans ----------------------------------------------------------------
@register("bulk_load_scan", SQL_SCAN_ORDERS)
def q_bulk_load_scan(spark, d):
    t = new_table(spark, "bulkload", ORDER_FAMILIES, key_splits(spark, d))
    bulk_load(t, order_cells(tbl(spark, d, "orders")), staging=new_path(spark, "staging"))
    return decoded(read_table(t))


@register("scan_all", _newest(SQL_EVENT_CELLS))
def q_scan_all(spark, d):
    return decoded(read_table(event_table(spark, d)))


@register("latest_cells", _newest("""
  SELECT CAST(user_id AS VARCHAR) AS row, event_type AS family, 'value' AS qualifier, epoch_us(ts) // 1000 AS ts,
         CASE WHEN event_id % 2 = 0 THEN printf('%.2f', value + 1.0) ELSE printf('%.2f', value) END AS value,
         event_id AS seq
  FROM events"""))
def q_latest_cells(spark, d):
    t = event_table(spark, d)
    ev = tbl(spark, d, "events")
    # the same cells again in a later load, for every other event, with a new value:
    # equal (row, family, qualifier, ts) -> the later load wins
    again = event_cells(ev.where(F.col("event_id") % 2 == 0),
                        value=F.format_string("%.2f", F.col("value") + F.lit(1.0)))
    bulk_put(t, again)
    return decoded(read_table(t))


@register("n_versions", _newest(SQL_EVENT_CELLS, n=3))
def q_n_versions(spark, d):
    return decoded(read_table(event_table(spark, d), versions=3))


RANGE = (f"{3000:019d}", f"{9000:019d}")


@register("scan_range", SQL_SCAN_ORDERS + f" WHERE row >= '{RANGE[0]}' AND row < '{RANGE[1]}'")
def q_scan_range(spark, d):
    return decoded(read_table(order_table(spark, d), start_row=RANGE[0], stop_row=RANGE[1]))


@register("scan_columns", SQL_SCAN_ORDERS + """
 WHERE family IN ('price', 'status') AND ts >= 820454400000 AND ts < 883612800000
""")
def q_scan_columns(spark, d):
    t = order_table(spark, d)
    # 1996-01-01 <= order date < 1998-01-01
    return decoded(read_table(t, families=["price", "status"], qualifiers=["o_totalprice", "o_orderstatus"],
                              ts_range=(820454400000, 883612800000)))


@register("scan_ordered_rank", f"""
SELECT row, row_number() OVER (ORDER BY row) AS rank FROM (SELECT DISTINCT row FROM ({SQL_ORDER_CELLS}))
""")
def q_scan_ordered_rank(spark, d):
    t = order_table(spark, d)
    ranked = rows_in_order(read_table(t), t.starts)
    return ranked.select(from_bytes("row").alias("row"), "rank")


@register("bulk_load_thin_rows", f"""
WITH l AS (SELECT {sql_key('l_orderkey')} AS row,
       CAST(l_linenumber AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR) || ':' ||
       strftime(l_shipdate, '%Y%m%d') || ':' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q,
       l_extendedprice, l_quantity FROM lineitem)
SELECT row, 'line' AS family, q || ':p' AS qualifier, printf('%.2f', l_extendedprice) AS value FROM l
UNION ALL
SELECT row, 'line', q || ':q', CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) FROM l
""")
def q_bulk_load_thin_rows(spark, d):
    t = new_table(spark, "thin", ["line"], key_splits(spark, d))
    # the raw line is the element; its cells are built after the exchange
    bulk_load_thin_rows(t, tbl(spark, d, "lineitem"), thin_line_row(), thin_line_cells(), ts=0)
    return decoded(read_table(t), with_ts=False)


@register("load_text_job", f"""
SELECT t[1] AS row, t[2] AS family, t[3] AS qualifier, t[4] AS value FROM (
  SELECT CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[]
         ELSE string_split(rtrim(line, ' '), ' ') END AS t
  FROM (SELECT {sql_key('o_orderkey')} || ' status o_orderpriority ' || o_orderpriority AS line FROM orders))
WHERE len(t) = 4
""")
def q_load_text_job(spark, d):
    from .jobs import load_text_job

    src = write_lines(tbl(spark, d, "orders").select(cell_line().alias("line")), new_path(spark, "job-input"))
    t = load_text_job(spark, new_path(spark, "job-table"), input_path=src, families=["status"],
                      split_keys=key_splits(spark, d), ts=0)
    return decoded(read_table(t), with_ts=False)


@register("region_sorted", f"""
SELECT family, {sql_order_region('CAST(row AS BIGINT)')} AS region, count(*) AS n_cells, CAST(0 AS BIGINT) AS n_unsorted
FROM ({SQL_ORDER_CELLS}) GROUP BY 1, 2
""")
def q_region_sorted(spark, d):
    return file_order_violations(order_table(spark, d))


@register("load_manifest", f"""
SELECT family, {sql_order_region('CAST(row AS BIGINT)')} AS region, count(*) AS n_cells, min(row) AS min_row,
       max(row) AS max_row, min(ts) AS min_ts, max(ts) AS max_ts
FROM ({SQL_ORDER_CELLS}) GROUP BY 1, 2
""")
def q_load_manifest(spark, d):
    m = order_table(spark, d).manifest()
    return m.select("family", "region", "n_cells", from_bytes("min_row").alias("min_row"),
                    from_bytes("max_row").alias("max_row"), "min_ts", "max_ts")


@register("file_rolling", SQL_SCAN_ORDERS)
def q_file_rolling(spark, d):
    t = new_table(spark, "rolling", ORDER_FAMILIES, key_splits(spark, d))
    # small byte target -> several files per (family, region)
    bulk_load(t, order_cells(tbl(spark, d, "orders")), file_bytes=64 * 1024)
    return decoded(read_table(t))


@register("load_clock", """
SELECT 3 * count(*) AS n_cells, true AS in_time, true AS one_clock FROM orders
""")
def q_load_clock(spark, d):
    """cells without a time get the clock, one value a load."""
    t = new_table(spark, "clock", ORDER_FAMILIES, key_splits(spark, d))
    before = int(time.time() * 1000)
    bulk_load(t, order_cells(tbl(spark, d, "orders")).drop("ts"))
    after = int(time.time() * 1000)
    return read_table(t).agg(
        F.count("*").alias("n_cells"), ((F.min("ts") >= before) & (F.max("ts") <= after)).alias("in_time"),
        (F.min("ts") == F.max("ts")).alias("one_clock"))


@register("load_target_exists", """
SELECT true AS refused, CAST(0 AS BIGINT) AS n_before, 3 * count(*) AS n_after FROM orders
""")
def q_load_target_exists(spark, d):
    """A load whose staging folder exists fails before any work and leaves the table as it was."""
    t = new_table(spark, "target", ORDER_FAMILIES, key_splits(spark, d))
    cells, taken = order_cells(tbl(spark, d, "orders")), new_path(spark, "taken")
    cells.limit(1).select("row").write.parquet(taken)
    try:
        bulk_load(t, cells, staging=taken)
        refused = False
    except FileExistsError:
        refused = True
    before = read_table(t).count()
    bulk_load(t, cells, staging=new_path(spark, "free"))
    return read_table(t).agg(F.lit(refused).alias("refused"), F.lit(before).cast("bigint").alias("n_before"),
                             F.count("*").alias("n_after"))


@register("family_codecs", """
SELECT f.family, f.codec, count(*) AS n_cells FROM orders, (VALUES ('status', 'snappy'), ('price', 'gz'), ('date', 'zstd')) f(family, codec)
GROUP BY ALL
""")
def q_family_codecs(spark, d):
    """The files of each family are written with the family's own options."""
    t = new_table(spark, "codecs", ORDER_FAMILIES, key_splits(spark, d))
    for family, codec in (("status", "snappy"), ("price", "gzip"), ("date", "zstd")):
        t = set_family_options(t, family, compression=codec)
    bulk_load(t, order_cells(tbl(spark, d, "orders")))
    codec = F.regexp_extract(F.col("_metadata.file_name"), r"\.([a-z]+)\.parquet$", 1)
    return t.stored().groupBy("family", codec.alias("codec")).agg(F.count("*").alias("n_cells"))


# --- mutations over the events table --------------------------------------------
def _users(ev, cond):
    return ev.where(cond).select(F.encode(F.col("user_id").cast("string"), "UTF-8").alias("row")).distinct()


def _ev_sql(where_hidden: str) -> str:
    return _newest(f"SELECT * FROM ({SQL_EVENT_CELLS}) p WHERE NOT ({where_hidden})")


SQL_VERSION_DELETED = ("EXISTS (SELECT 1 FROM events e2 WHERE e2.event_id % 10 = 3 AND e2.user_id = p.user_id "
                       "AND e2.event_type = p.family AND epoch_us(e2.ts) // 1000 = p.ts)")


@register("bulk_delete_row", _ev_sql(f"p.user_id % 10 = 0 AND p.ts <= {T_DEL}"))
def q_bulk_delete_row(spark, d):
    t = event_table(spark, d)
    ev = tbl(spark, d, "events")
    bulk_delete(t, _users(ev, F.col("user_id") % 10 == 0), scope="row", ts=T_DEL)
    return decoded(read_table(t))


@register("bulk_delete_family", _ev_sql(f"p.user_id % 7 = 0 AND p.family = 'click' AND p.ts <= {T_DEL}"))
def q_bulk_delete_family(spark, d):
    t = event_table(spark, d)
    ev = tbl(spark, d, "events")
    dels = _users(ev, F.col("user_id") % 7 == 0).withColumn("family", F.lit("click"))
    bulk_delete(t, dels, scope="family", ts=T_DEL)
    return decoded(read_table(t))


@register("bulk_delete_column", _ev_sql(f"p.user_id % 5 = 1 AND p.family = 'view' AND p.ts <= {T_DEL}"))
def q_bulk_delete_column(spark, d):
    t = event_table(spark, d)
    ev = tbl(spark, d, "events")
    dels = _users(ev, F.col("user_id") % 5 == 1).withColumn("family", F.lit("view")).withColumn(
        "qualifier", F.encode(F.lit("value"), "UTF-8"))
    bulk_delete(t, dels, scope="column", ts=T_DEL)
    return decoded(read_table(t))


def _version_deletes(ev):
    return event_cells(ev.where(F.col("event_id") % 10 == 3)).select("row", "family", "qualifier", "ts")


@register("bulk_delete_version", _ev_sql(SQL_VERSION_DELETED))
def q_bulk_delete_version(spark, d):
    t = event_table(spark, d)
    bulk_delete(t, _version_deletes(tbl(spark, d, "events")), scope="version")
    return decoded(read_table(t))


@register("apply_mutations", _ev_sql(f"(p.user_id % 10 = 0 AND p.ts <= {T_DEL}) OR {SQL_VERSION_DELETED}"))
def q_apply_mutations(spark, d):
    t = new_table(spark, "mutations", EVENT_FAMILIES, EVENT_SPLITS)
    ev = tbl(spark, d, "events")
    puts = event_cells(ev).withColumn("op", F.lit(PUT))
    rows = _users(ev, F.col("user_id") % 10 == 0)
    row_dels = rows.select("row", F.lit(None).cast("string").alias("family"), F.lit(None).cast("binary").alias(
        "qualifier"), F.lit(T_DEL).cast("bigint").alias("ts"), F.lit(None).cast("binary").alias("value"),
        F.lit(0).cast("bigint").alias("seq"), F.lit(DELETE_FAMILY).alias("op"))
    ver = _version_deletes(ev).select("row", "family", F.encode("qualifier", "UTF-8").alias("qualifier"), "ts",
                                      F.lit(None).cast("binary").alias("value"), F.lit(0).cast("bigint").alias("seq"),
                                      F.lit(DELETE_VERSION).alias("op"))
    p = puts.select("row", "family", F.encode("qualifier", "UTF-8").alias("qualifier"), "ts",
                    F.encode("value", "UTF-8").alias("value"), "seq", "op")
    apply_mutations(t, p.unionByName(row_dels).unionByName(ver))
    return decoded(read_table(t))


SQL_VISIBLE = _newest(f"""
  SELECT * FROM (
    SELECT row, family, qualifier, ts, value, 1 AS load, seq, user_id FROM ({SQL_EVENT_CELLS})
    UNION ALL
    SELECT CAST(user_id AS VARCHAR), 'click', 'value', {T_DEL}, 'tie', 5, 0, user_id
      FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 10 = 0)
    UNION ALL
    SELECT CAST(user_id AS VARCHAR), 'click', 'value', {T_DEL + 1}, 'again', 5, 1, user_id
      FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 10 = 0)) p
  WHERE NOT ((p.user_id % 10 = 0 AND p.ts <= {T_DEL})
          OR (p.user_id % 5 = 1 AND p.family = 'view' AND p.ts <= {T_DEL})
          OR {SQL_VERSION_DELETED})""", extra_order="load DESC, seq DESC")


def _deleted_events(spark, d):
    """Events with deletes of every scope, and puts at and after a tombstone's time."""
    t = event_table(spark, d)
    ev = tbl(spark, d, "events")
    bulk_delete(t, _users(ev, F.col("user_id") % 10 == 0), scope="row", ts=T_DEL)
    cols = _users(ev, F.col("user_id") % 5 == 1).withColumn("family", F.lit("view")).withColumn(
        "qualifier", F.encode(F.lit("value"), "UTF-8"))
    bulk_delete(t, cols, scope="column", ts=T_DEL)
    bulk_delete(t, _version_deletes(ev), scope="version")
    # puts again: at the tombstone's time (stays hidden) and just after it
    users = _users(ev, F.col("user_id") % 10 == 0)
    again = users.select("row", F.lit("click").alias("family"), F.lit("value").alias("qualifier"),
                         F.lit(T_DEL).cast("bigint").alias("ts"), F.lit("tie").alias("value"),
                         F.lit(0).cast("bigint").alias("seq")).unionByName(
        users.select("row", F.lit("click").alias("family"), F.lit("value").alias("qualifier"),
                     F.lit(T_DEL + 1).cast("bigint").alias("ts"), F.lit("again").alias("value"),
                     F.lit(1).cast("bigint").alias("seq")))
    bulk_put(t, again)
    return t


@register("visible_cells", SQL_VISIBLE)
def q_visible_cells(spark, d):
    return decoded(read_table(_deleted_events(spark, d)))


@register("visible_cells_sweep", SQL_VISIBLE)
def q_visible_cells_sweep(spark, d):
    # as if the tombstones were too large to broadcast: one exchange of puts and tombstones
    return decoded(read_table(_deleted_events(spark, d), broadcast_bytes=0))


@register("bulk_put_scan", f"SELECT row, value FROM ({SQL_KV_CELLS})")
def q_bulk_put_scan(spark, d):
    t = new_table(spark, "put", ["family"], ["aaa", "bbb"])
    bulk_put(t, kv_cells(spark, d))
    return read_table(t).select(from_bytes("row").alias("row"), from_bytes("value").alias("value"))


@register("put_then_get", f"SELECT row, value FROM ({SQL_KV_CELLS})")
def q_put_then_get(spark, d):
    t = new_table(spark, "putget", ["family"], ["aaa", "bbb"])
    cells = kv_cells(spark, d)
    bulk_put(t, cells)
    got = bulk_get(cells.select("row").distinct(), t, [("family", "qualifier", "value")])
    return got.where(F.col("found")).select(from_bytes("row").alias("row"), from_bytes("value").alias("value"))


@register("table_row_count", "SELECT count(*) AS n_rows FROM orders WHERE o_orderkey % 4 <> 0")
def q_table_row_count(spark, d):
    t = order_table(spark, d)
    o = tbl(spark, d, "orders")
    bulk_delete(t, o.where(F.col("o_orderkey") % 4 == 0).select(padded_key("o_orderkey").alias("row")),
                scope="row", ts=T_FUTURE)
    return table_row_count(t)


@register("cell_presence_count", """
SELECT 'status' AS family, 'o_orderstatus' AS qualifier, count(*) AS n_present FROM orders
UNION ALL SELECT 'price', 'o_totalprice', count(*) FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT 'date', 'o_orderdate', count(*) FROM orders WHERE o_orderkey % 4 = 1
""")
def q_cell_presence_count(spark, d):
    t = new_table(spark, "presence", ORDER_FAMILIES, key_splits(spark, d))
    c = order_cells(tbl(spark, d, "orders"))
    keep = (F.col("family") == "status") | ((F.col("family") == "price") & (F.col("seq") % 3 != 0)) | (
        (F.col("family") == "date") & (F.col("seq") % 4 == 1))
    bulk_load(t, c.where(keep))
    expected = [("status", "o_orderstatus"), ("price", "o_totalprice"), ("date", "o_orderdate")]
    return cell_presence_count(read_table(t), expected)


@register("wide_rows", f"""
SELECT {sql_key('c_custkey')} AS row, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       printf('%.2f', c_acctbal) AS c_acctbal, c_mktsegment FROM customer
""")
def q_wide_rows(spark, d):
    cols = [("info", q, q) for q in ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")]
    w = wide_rows(read_table(customer_table(spark, d)), cols)
    return w.select(from_bytes("row").alias("row"), *[from_bytes(q).alias(q) for _, _, q in cols])


ARRIVAL = ["l_partkey", "l_suppkey", "quantity", "shipped"]


@register("collapse_identical", f"""
WITH l AS (SELECT {sql_key('l_orderkey')} AS row, CAST(l_linenumber AS VARCHAR) AS qualifier,
                  printf('%.2f', l_extendedprice) AS value, l_partkey, l_suppkey,
                  CAST(l_quantity AS BIGINT) AS quantity, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM lineitem)
SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY row, qualifier) AS n_collapsed FROM l
               QUALIFY row_number() OVER (PARTITION BY row, qualifier
                 ORDER BY l_partkey DESC, l_suppkey DESC, quantity DESC, shipped DESC, value DESC) = 1)
""")
def q_collapse_identical(spark, d):
    l = tbl(spark, d, "lineitem")
    cells = l.select(padded_key("l_orderkey").alias("row"), F.lit("line").alias("family"),
                     F.encode(F.col("l_linenumber").cast("string"), "UTF-8").alias("qualifier"),
                     F.lit(0).cast("bigint").alias("ts"), F.lit(PUT).cast("tinyint").alias("op"),
                     F.encode(F.format_string("%.2f", "l_extendedprice"), "UTF-8").alias("value"),
                     "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("quantity"),
                     F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"))
    n = cells.groupBy("row", "qualifier").agg(F.count(F.lit(1)).alias("n_collapsed"))
    c = collapse_identical(cells, arrival=[*ARRIVAL, "value"]).join(n, ["row", "qualifier"])
    return c.select(from_bytes("row").alias("row"), from_bytes("qualifier").alias("qualifier"),
                    from_bytes("value").alias("value"), *ARRIVAL, "n_collapsed")


@register("collapse_on_load", f"""
SELECT {sql_key('l_orderkey')} AS row, CAST(l_linenumber AS VARCHAR) AS qualifier,
       arg_max(printf('%.2f', l_extendedprice), l_suppkey * 100 + CAST(l_quantity AS BIGINT)) AS value
FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_shipdate DESC, l_extendedprice DESC) = 1)
GROUP BY l_orderkey, l_linenumber
""")
def q_collapse_on_load(spark, d):
    """A7 as part of a load: the files hold one cell per full key."""
    t = new_table(spark, "collapsed", ["line"], key_splits(spark, d))
    l = tbl(spark, d, "lineitem")
    cells = l.select(padded_key("l_orderkey").alias("row"), F.lit("line").alias("family"),
                     F.col("l_linenumber").cast("string").alias("qualifier"),
                     F.lit(0).cast("bigint").alias("ts"), F.format_string("%.2f", "l_extendedprice").alias("value"),
                     "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_extendedprice")
    bulk_load(t, cells, collapse=["l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_extendedprice"])
    return t.stored().select(from_bytes("row").alias("row"), from_bytes("qualifier").alias("qualifier"),
                             from_bytes("value").alias("value"))


# --- lookups ----------------------------------------------------------------------------
def _requests(spark, d):
    o = tbl(spark, d, "orders")
    k = F.when(F.col("o_orderkey") % 13 == 0, F.col("o_custkey") + F.lit(MISS_SHIFT)).otherwise(F.col("o_custkey"))
    return o.select("o_orderkey", F.encode(text_key(k), "UTF-8").alias("row"))


SQL_REQ = f"""
  SELECT o_orderkey, {sql_key(f'CASE WHEN o_orderkey % 13 = 0 THEN o_custkey + {MISS_SHIFT} ELSE o_custkey END')}
         AS row FROM orders
"""


@register("bulk_get_hash_filter", f"""
SELECT {sql_key('l_orderkey')} AS row, l_linenumber, o_orderstatus AS status, true AS found
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def q_bulk_get_hash_filter(spark, d):
    # as if the keys of all lines were too large to broadcast; two of three rows of the table are asked for by none
    o = tbl(spark, d, "orders")
    cell = [F.lit("status").alias("family"), F.lit("s").alias("qualifier"), F.col("o_orderstatus").alias("value"),
            F.lit(1).cast("long").alias("ts"), F.col("o_orderkey").alias("seq")]
    tail = F.explode(F.array(F.lit(""), F.lit("x"), F.lit("y"))).alias("tail")
    rows = o.select("*", tail).select(F.concat(padded_key("o_orderkey"), F.encode("tail", "UTF-8")).alias("row"), *cell)
    t = new_table(spark, "filtered-get", ["status"], key_splits(spark, d))
    bulk_load(t, rows)
    asked = tbl(spark, d, "lineitem").select(padded_key("l_orderkey").alias("row"), "l_linenumber")
    got = bulk_get(asked, t, [("status", "s", "status")], broadcast_bytes=0)
    return got.select(from_bytes("row").alias("row"), "l_linenumber", from_bytes("status").alias("status"), "found")


@register("bulk_get", f"""
SELECT r.o_orderkey, r.row, c.c_name, printf('%.2f', c.c_acctbal) AS c_acctbal, c.c_custkey IS NOT NULL AS found
FROM ({SQL_REQ}) r LEFT JOIN customer c ON {sql_key('c.c_custkey')} = r.row
""")
def q_bulk_get(spark, d):
    t = customer_table(spark, d)
    g = bulk_get(_requests(spark, d), t, [("info", "c_name", "c_name"), ("info", "c_acctbal", "c_acctbal")])
    return g.select("o_orderkey", from_bytes("row").alias("row"), from_bytes("c_name").alias("c_name"),
                    from_bytes("c_acctbal").alias("c_acctbal"), "found")


@register("bulk_get_pairs", f"""
SELECT o_orderkey, o_orderstatus AS status, CASE WHEN o_orderkey % 2 = 0 THEN printf('%.2f', o_totalprice) END AS price,
       true AS found FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT o_orderkey, NULL, NULL, false FROM orders WHERE o_orderkey % 3 = 0
""")
def q_bulk_get_pairs(spark, d):
    """Named pairs of two families; the other family-qualifier combinations
    are there as decoys, alone in every third row."""
    t = new_table(spark, "pairs", ["price", "status"], key_splits(spark, d))
    o = tbl(spark, d, "orders")
    c = lambda f, q, v: F.struct(F.lit(f).alias("family"), F.lit(q).alias("qualifier"), v.alias("value"))
    price = F.format_string("%.2f", "o_totalprice")
    cells = F.array(F.when(F.col("o_orderkey") % 3 != 0, c("status", "s", F.col("o_orderstatus"))),
                    F.when((F.col("o_orderkey") % 3 != 0) & (F.col("o_orderkey") % 2 == 0), c("price", "p", price)),
                    c("status", "p", F.lit("decoy")), c("price", "s", F.lit("decoy")))
    one = o.select(padded_key("o_orderkey").alias("row"), F.explode(cells).alias("c")).where("c is not null")
    bulk_load(t, one.select("row", "c.*"), ts=1)
    req = o.select("o_orderkey", padded_key("o_orderkey").alias("row"))
    g = bulk_get(req, t, [("status", "s", "status"), ("price", "p", "price")])
    return g.select("o_orderkey", from_bytes("status").alias("status"), from_bytes("price").alias("price"), "found")


@register("bulk_get_rows", f"""
WITH c AS (SELECT row, count(*) AS n, string_agg(qualifier || '=' || value, '|' ORDER BY qualifier) AS cells
           FROM ({SQL_CUSTOMER_CELLS}) GROUP BY row)
SELECT r.o_orderkey, r.row, coalesce(c.n, 0) AS n_cells, coalesce(c.cells, '') AS cells
FROM ({SQL_REQ}) r LEFT JOIN c ON c.row = r.row
""")
def q_bulk_get_rows(spark, d):
    """One row per request with all its cells; an absent row has none."""
    g = bulk_get_rows(_requests(spark, d), customer_table(spark, d))
    text = F.transform("cells", lambda c: F.concat(F.decode(c["qualifier"], "UTF-8"), F.lit("="),
                                                   F.decode(c["value"], "UTF-8")))
    return g.select("o_orderkey", from_bytes("row").alias("row"), F.size("cells").cast("bigint").alias("n_cells"),
                    F.array_join(text, "|").alias("cells"))


@register("bulk_get_exists", f"""
SELECT r.o_orderkey, r.row FROM ({SQL_REQ}) r WHERE r.row IN (SELECT {sql_key('c_custkey')} FROM customer)
""")
def q_bulk_get_exists(spark, d):
    g = bulk_get_exists(_requests(spark, d), customer_table(spark, d))
    return g.select("o_orderkey", from_bytes("row").alias("row"))


@register("bulk_get_missing", f"""
SELECT r.o_orderkey, r.row FROM ({SQL_REQ}) r WHERE r.row NOT IN (SELECT {sql_key('c_custkey')} FROM customer)
""")
def q_bulk_get_missing(spark, d):
    g = bulk_get_missing(_requests(spark, d), customer_table(spark, d))
    return g.select("o_orderkey", from_bytes("row").alias("row"))


@register("bulk_get_columns", f"""
SELECT r.o_orderkey, r.row, c.c_mktsegment FROM ({SQL_REQ}) r
LEFT JOIN customer c ON {sql_key('c.c_custkey')} = r.row
""")
def q_bulk_get_columns(spark, d):
    g = bulk_get(_requests(spark, d), customer_table(spark, d), [("info", "c_mktsegment", "c_mktsegment")])
    return g.select("o_orderkey", from_bytes("row").alias("row"), from_bytes("c_mktsegment").alias("c_mktsegment"))


@register("bulk_get_versions", f"""
SELECT c.c_custkey, v.ts, v.value FROM customer c LEFT JOIN (
  {_newest(f"SELECT * FROM ({SQL_EVENT_CELLS}) WHERE family = 'purchase'", n=2)}) v
ON CAST(c.c_custkey AS VARCHAR) = v.row
""")
def q_bulk_get_versions(spark, d):
    t = event_table(spark, d)
    req = tbl(spark, d, "customer").select("c_custkey", F.encode(F.col("c_custkey").cast("string"), "UTF-8")
                                           .alias("row"))
    g = bulk_get_cells(req, t, families=["purchase"], qualifiers=["value"], versions=2)
    return g.select("c_custkey", "ts", from_bytes("value").alias("value"))


@register("bulk_get_event_time", f"""
SELECT e.event_id, c.c_name,
       epoch_us(date_trunc('day', e.ts) + INTERVAL 1 DAY) // 1000 - 1 AS event_ts
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
""")
def q_bulk_get_event_time(spark, d):
    ev = tbl(spark, d, "events")
    req = ev.select("event_id", padded_key("user_id").alias("row"), "ts")
    # The event time of an output is the max timestamp of its window (1 day)
    w_end = F.window("ts", "1 day").end
    g = bulk_get(req, customer_table(spark, d), [("info", "c_name", "c_name")],
                 event_time=epoch_millis(w_end) - F.lit(1))
    return g.select("event_id", from_bytes("c_name").alias("c_name"), "event_ts")


@register("windowed_groups", """
SELECT epoch_us(date_trunc('day', ts) + INTERVAL 1 DAY) // 1000 - 1 AS group_ts, user_id,
       count(*) AS n, CAST(sum(round(value * 100)) AS BIGINT) AS total_cents
FROM events GROUP BY 1, 2
""")
def q_windowed_groups(spark, d):
    ev = tbl(spark, d, "events")
    g = ev.groupBy(F.window("ts", "1 day").alias("w"), "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("value")).cast("bigint").alias("total_cents"))
    return g.select((epoch_millis(F.col("w.end")) - F.lit(1)).alias("group_ts"), "user_id", "n", "total_cents")


# --- publish and maintenance --------------------------------------------------------
@register("publish_visibility", """
SELECT 'staged' AS phase, 2 * count(*) AS n_cells FROM orders
UNION ALL SELECT 'published', 3 * count(*) FROM orders
""")
def q_publish_visibility(spark, d):
    t = new_table(spark, "publish", ORDER_FAMILIES, key_splits(spark, d))
    cells = order_cells(tbl(spark, d, "orders"))
    bulk_load(t, cells.where(F.col("family").isin("status", "date")))
    staged = stage(t, cells.where(F.col("family") == "price"), new_path(spark, "staging"))
    n_staged = read_table(t).count()
    publish_staged(t, staged)
    n_pub = read_table(t).agg(F.count(F.lit(1)).alias("n_cells"))
    first = spark.range(1).select(F.lit("staged").alias("phase"), F.lit(n_staged).cast("bigint").alias("n_cells"))
    return first.unionByName(n_pub.select(F.lit("published").alias("phase"), "n_cells"))


@register("compaction_equivalence", SQL_SCAN_ORDERS + " WHERE CAST(row AS BIGINT) % 10 <> 0")
def q_compaction_equivalence(spark, d):
    t = order_table(spark, d, "compact", loads=3)
    o = tbl(spark, d, "orders")
    bulk_delete(t, o.where(F.col("o_orderkey") % 10 == 0).select(padded_key("o_orderkey").alias("row")),
                scope="row", ts=T_FUTURE)
    compact(t, max_files=1)             # minor: merges the four loads, keeps tombstones
    bulk_put(t, order_cells(o.where(F.col("o_orderkey") % 10 == 5)))   # same cells again after it
    compact(t, major=True)              # major: applies and drops tombstones
    return decoded(read_table(t))


@register("compaction_respects_flag", """
SELECT 'load' AS kind, true AS exclude_from_minor, count(*) AS n_cells FROM orders
UNION ALL SELECT 'minor', false, 2 * count(*) FROM orders
""")
def q_compaction_respects_flag(spark, d):
    t = new_table(spark, "flag", ORDER_FAMILIES, key_splits(spark, d))
    cells = order_cells(tbl(spark, d, "orders"))
    bulk_load(t, cells.where(F.col("family") == "status"), exclude_from_minor=True)
    bulk_load(t, cells.where((F.col("family") == "status") & F.lit(False)))  # an empty load
    for i in range(2):
        bulk_load(t, cells.where(F.col("family").isin("price", "date") & (F.col("seq") % 2 == i)))
    compact(t, max_files=1)
    return live_groups(t).groupBy("kind", "exclude_from_minor").agg(F.sum("n_cells").cast("bigint").alias("n_cells"))


@register("manifest_after_major", f"""
SELECT family, {sql_order_region('o_orderkey')} AS region, count(*) AS n_cells, true AS merged
FROM ({SQL_ORDER_CELLS}) WHERE {sql_order_region('o_orderkey')} <> 3 GROUP BY 1, 2
UNION ALL SELECT f, 3, 0, true FROM (SELECT unnest(['date', 'price', 'status']) AS f)
""")
def q_manifest_after_major(spark, d):
    """One region emptied by row deletes: after a major compaction its groups
    are live with no cell, and nothing is left to merge."""
    t = order_table(spark, d, "emptied", loads=2)
    o = tbl(spark, d, "orders").select(padded_key("o_orderkey").alias("row"))
    _, lo, hi = t.region_ranges()[3]
    gone = o.where((F.col("row") >= F.lit(bytearray(lo))) & (F.col("row") < F.lit(bytearray(hi))))
    bulk_delete(t, gone, scope="row", ts=T_FUTURE)
    compact(t, major=True)
    again = compact(t, max_files=1)
    return live_groups(t).groupBy("family", "region").agg(F.sum("n_cells").cast("bigint").alias("n_cells")).withColumn(
        "merged", F.lit(again is None))

