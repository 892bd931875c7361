"""Queries over text and scalar functions: S1, S3, S4, F1-F8, F10-F14, A2, A3."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bytes import cell_size, from_bytes, int_key, text_key, to_bytes
from ..functions.regions import region_index
from ..functions.text import (java_split, kv_format, multi_cells_row, parse_cells, parse_kv, parse_multi_cells,
                              split_lines)
from ..operators.aggregate import count_per_element, count_rows
from ..session import new_path
from ..sources.generate import gen_lines
from ..sources.text import read_lines, write_lines
from .fixtures import (KEY_DIGITS, N_REGIONS, PROBE_STARTS, SQL_LINES, SQL_ORDER_CELLS, key_splits, order_cells,
                       sql_java_split, sql_key, sql_order_region, sql_region, tbl)
from .registry import register


def _lines(spark, d):
    docs = tbl(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.explode(split_lines("text")).alias("line"))


def _word_count(spark, d):
    words = _lines(spark, d).select(F.explode(java_split("line")).alias("word"))
    wc = count_per_element(words, "word")
    return wc.select("word", "n", kv_format("word", "n").alias("kv"))


SQL_WORDS = f"""
WITH lines AS ({SQL_LINES}),
toks AS (SELECT doc_id, {sql_java_split('line')} AS t FROM lines),
words AS (SELECT unnest(t) AS word FROM toks)
"""

register("word_count", SQL_WORDS + """
SELECT word, count(*) AS n, word || ':' || CAST(count(*) AS VARCHAR) AS kv FROM words GROUP BY word
""")(_word_count)


@register("java_split", f"""
WITH lines AS ({SQL_LINES}),
toks AS (SELECT doc_id, {sql_java_split('line')} AS t FROM lines)
SELECT doc_id, count(*) AS n_lines, CAST(sum(len(t)) AS BIGINT) AS n_tokens,
       CAST(sum(len(list_filter(t, lambda x: x = ''))) AS BIGINT) AS n_empty
FROM toks GROUP BY doc_id
""")
def q_java_split(spark, d):
    t = _lines(spark, d).select("doc_id", java_split("line").alias("t"))
    return t.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.size("t")).cast("bigint").alias("n_tokens"),
        F.sum(F.size(F.filter("t", lambda x: x == F.lit("")))).cast("bigint").alias("n_empty"),
    )


@register("explode_words", f"""
WITH lines AS ({SQL_LINES}),
toks AS (SELECT doc_id, {sql_java_split('line')} AS t FROM lines),
words AS (SELECT doc_id, unnest(t) AS word FROM toks)
SELECT doc_id, count(*) AS n_tokens, count(DISTINCT word) AS n_distinct FROM words GROUP BY doc_id
""")
def q_explode_words(spark, d):
    w = _lines(spark, d).select("doc_id", F.explode(java_split("line")).alias("word"))
    return w.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"), F.count_distinct("word").alias("n_distinct"))


@register("text_lines", f"""
SELECT line, count(*) AS n FROM ({SQL_LINES}) GROUP BY line
""")
def q_text_lines(spark, d):
    # documents -> text files (Spark job) -> S1 line source
    path = write_lines(tbl(spark, d, "documents").select("text"), new_path(spark, "docs-text"))
    return count_per_element(read_lines(spark, path), "line")


@register("text_sink_roundtrip", SQL_WORDS + """
SELECT word || ':' || CAST(count(*) AS VARCHAR) AS line FROM words GROUP BY word
""")
def q_text_sink_roundtrip(spark, d):
    path = write_lines(_word_count(spark, d).select("kv"), new_path(spark, "wc-text"), num_shards=2)
    return read_lines(spark, path)


@register("count_rows", "SELECT count(*) AS n FROM lineitem")
def q_count_rows(spark, d):
    return count_rows(tbl(spark, d, "lineitem"))


# --- line parsers over lines built from orders ------------------------------
def _kv_line():
    v = F.when(F.col("o_orderkey") % 7 == 0, F.col("o_orderpriority")).otherwise(F.col("o_orderstatus"))
    return F.concat_ws(" ", text_key("o_orderkey"), v)


SQL_KV_LINES = f"""
  SELECT {sql_key('o_orderkey')} || ' ' ||
         (CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority ELSE o_orderstatus END) AS line FROM orders
"""


def kv_cells(spark, d):
    """F3 over orders: puts into family ``family``, qualifier ``qualifier``."""
    o = tbl(spark, d, "orders")
    c = o.select(parse_kv(_kv_line(), "family", "qualifier", F.lit(0)).alias("c"))
    return c.where(F.col("c").isNotNull()).select("c.*")


SQL_KV_CELLS = f"""
  SELECT t[1] AS row, 'family' AS family, 'qualifier' AS qualifier, CAST(0 AS BIGINT) AS ts, t[2] AS value
  FROM (SELECT {sql_java_split('line')} AS t FROM ({SQL_KV_LINES})) WHERE len(t) = 2
"""


@register("parse_kv", SQL_KV_CELLS)
def q_parse_kv(spark, d):
    return kv_cells(spark, d).select(
        from_bytes("row").alias("row"), "family", from_bytes("qualifier").alias("qualifier"), "ts",
        from_bytes("value").alias("value"))


def cell_line():
    return F.concat_ws(" ", text_key("o_orderkey"), F.lit("status"), F.lit("o_orderpriority"), F.col("o_orderpriority"))


SQL_CELL_LINES = f"""
  SELECT {sql_key('o_orderkey')} || ' status o_orderpriority ' || o_orderpriority AS line FROM orders
"""
SQL_PARSED_CELLS = f"""
  SELECT t[1] AS row, t[2] AS family, t[3] AS qualifier, CAST(0 AS BIGINT) AS ts, t[4] AS value
  FROM (SELECT {sql_java_split('line')} AS t FROM ({SQL_CELL_LINES})) WHERE len(t) = 4
"""


@register("parse_cells", SQL_PARSED_CELLS)
def q_parse_cells(spark, d):
    o = tbl(spark, d, "orders")
    c = o.select(parse_cells(cell_line(), F.lit(0)).alias("c")).where(F.col("c").isNotNull())
    return c.select(from_bytes("c.row").alias("row"), "c.family", from_bytes("c.qualifier").alias("qualifier"),
                    "c.ts", from_bytes("c.value").alias("value"))


@register("parse_multi_cells", f"""
WITH l AS (SELECT {sql_key('o_orderkey')} || ' line qualifier0 ' || o_orderstatus || ' qualifier1 ' || o_orderpriority
                  AS line FROM orders),
t AS (SELECT {sql_java_split('line')} AS t FROM l)
SELECT t[1] AS row, CASE WHEN len(t) = 6 THEN 2 ELSE 0 END AS n_cells,
       CASE WHEN len(t) = 6 THEN t[4] || '|' || t[6] ELSE '' END AS vals FROM t
""")
def q_parse_multi_cells(spark, d):
    o = tbl(spark, d, "orders")
    line = F.concat_ws(" ", text_key("o_orderkey"), F.lit("line"), F.lit("qualifier0"), "o_orderstatus",
                       F.lit("qualifier1"), "o_orderpriority")
    x = o.select(multi_cells_row(line).alias("row"), parse_multi_cells(line, 2, F.lit(0)).alias("cells"))
    return x.select(
        from_bytes("row").alias("row"),
        F.size("cells").alias("n_cells"),
        F.concat_ws("|", F.transform("cells", lambda c: F.decode(c["value"], "UTF-8"))).alias("vals"),
    )


@register("map_drop_null", """
SELECT o_orderkey, o_orderstatus || ':' || o_orderpriority AS mapped FROM orders WHERE o_orderstatus <> 'P'
""")
def q_map_drop_null(spark, d):
    o = tbl(spark, d, "orders")
    m = F.when(F.col("o_orderstatus") != F.lit("P"), F.concat_ws(":", "o_orderstatus", "o_orderpriority"))
    return o.select("o_orderkey", m.alias("mapped")).where(F.col("mapped").isNotNull())


@register("gen_cells", """
SELECT s || CAST(o_orderkey AS VARCHAR) || ' ' || f || ' qualifier v[' || CAST(o_orderkey AS VARCHAR) || ']' AS line
FROM orders, (SELECT unnest(['aaa', 'bbb']) AS s), (SELECT unnest(['fam0', 'fam1', 'fam2']) AS f)
""")
def q_gen_cells(spark, d):
    return gen_lines(tbl(spark, d, "orders").select(F.col("o_orderkey").alias("i")), "i")


# --- regions ------------------------------------------------------------------
@register("region_index", f"""
SELECT region, count(*) AS n_rows, min(row) AS min_row, max(row) AS max_row FROM (
  SELECT {sql_key('o_orderkey')} AS row, {sql_region(sql_key('o_orderkey'), PROBE_STARTS)} AS region FROM orders)
GROUP BY region
""")
def q_region_index(spark, d):
    o = tbl(spark, d, "orders").select(text_key("o_orderkey").alias("row"))
    r = o.withColumn("region", region_index(F.encode("row", "UTF-8"), PROBE_STARTS))
    return r.groupBy("region").agg(F.count(F.lit(1)).alias("n_rows"), F.min("row").alias("min_row"),
                                   F.max("row").alias("max_row"))


@register("region_ranges", f"""
WITH k AS (SELECT i AS region, lpad(CAST(i * (SELECT max(o_orderkey) + 1 FROM orders) // {N_REGIONS} AS VARCHAR),
                                    {KEY_DIGITS}, '0') AS key FROM range({N_REGIONS}) t(i)),
r AS (SELECT region, CASE WHEN region = 0 THEN '' ELSE key END AS start_key,
             lead(key) OVER (ORDER BY region) AS stop_key FROM k),
c AS (SELECT {sql_order_region('o_orderkey')} AS region, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(r.region AS INTEGER) AS region, r.start_key, r.stop_key, COALESCE(c.n, 0) AS n_rows
FROM r LEFT JOIN c ON r.region = c.region
""")
def q_region_ranges(spark, d):
    from .fixtures import new_table

    # split keys handed over unsorted: the table sorts them (O2) without
    # touching the caller's list
    t = new_table(spark, "ranges", ["status"], list(reversed(key_splits(spark, d))))
    ranges = spark.createDataFrame(
        [(i, s.decode(), None if e is None else e.decode()) for i, s, e in t.region_ranges()],
        "region int, start_key string, stop_key string",
    )
    o = tbl(spark, d, "orders").select(region_index(F.encode(text_key("o_orderkey"), "UTF-8"), t.starts,
                                                    presorted=True).alias("region"))
    counts = o.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    return ranges.join(counts, "region", "left").select(
        "region", "start_key", "stop_key", F.coalesce(F.col("n"), F.lit(0)).alias("n_rows"))


SPLIT_REGIONS = 32


@register("region_splits_of_data", f"""
SELECT {SPLIT_REGIONS} AS n_regions, count(*) AS n_rows, true AS even FROM lineitem
""")
def q_region_splits_of_data(spark, d):
    """Split keys of a skewed text key (no number, most keys under a few prefixes)
    by a quantile sketch: no region holds over 1.5 times the mean."""
    from ..operators.splits import data_splits

    text = F.concat(F.when(F.col("l_orderkey") % 10 < 8, F.lit("item/a/")).otherwise(F.lit("z")),
                    F.sha1(F.concat_ws("|", "l_partkey", "l_suppkey")), F.lit("/"), F.col("l_orderkey").cast("string"))
    rows = tbl(spark, d, "lineitem").select(F.encode(text, "UTF-8").alias("row"))
    starts = [b"", *data_splits(rows, "row", SPLIT_REGIONS)]
    sizes = rows.groupBy(region_index("row", starts, presorted=True).alias("region")).agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").cast("int").alias("n_regions"), F.sum("n").alias("n_rows"),
                     (F.max("n") <= 1.5 * F.avg("n")).alias("even"))


# --- bytes ------------------------------------------------------------------------
@register("bytes_roundtrip", """
SELECT c_custkey, hex(encode(c_name)) AS name_hex, decode(encode(c_name)) AS name_back,
       CAST(octet_length(encode(c_name)) AS INTEGER) AS n_bytes FROM customer
""")
def q_bytes_roundtrip(spark, d):
    c = tbl(spark, d, "customer")
    b = to_bytes("c_name")
    return c.select("c_custkey", F.hex(b).alias("name_hex"), from_bytes(b).alias("name_back"),
                    F.octet_length(b).alias("n_bytes"))


@register("row_keys", """
SELECT o_orderkey, hex(encode('aaa' || CAST(o_orderkey AS VARCHAR))) AS key_hex FROM orders
""")
def q_row_keys(spark, d):
    from ..functions.bytes import concat_bytes

    o = tbl(spark, d, "orders")
    k = concat_bytes(F.encode(F.lit("aaa"), "UTF-8"), F.encode(F.col("o_orderkey").cast("string"), "UTF-8"))
    return o.select("o_orderkey", F.hex(k).alias("key_hex"))


@register("int_key_hex", """
SELECT o_orderkey, right(lpad(hex(CAST(o_orderkey - 7500 AS BIGINT)), 16, '0'), 8) AS key_hex FROM orders
""")
def q_int_key_hex(spark, d):
    o = tbl(spark, d, "orders")
    return o.select("o_orderkey", F.hex(int_key(F.col("o_orderkey") - F.lit(7500))).alias("key_hex"))


@register("cell_sizes", f"""
SELECT family, count(*) AS n_cells,
       CAST(sum(octet_length(encode(row)) + octet_length(encode(family)) + octet_length(encode(qualifier)) + 9
                + octet_length(encode(value))) AS BIGINT) AS total_bytes
FROM ({SQL_ORDER_CELLS}) GROUP BY family
""")
def q_cell_sizes(spark, d):
    c = order_cells(tbl(spark, d, "orders")).select(
        "row", "family", F.encode("qualifier", "UTF-8").alias("qualifier"), F.encode("value", "UTF-8").alias("value"))
    return c.groupBy("family").agg(F.count(F.lit(1)).alias("n_cells"), F.sum(cell_size()).cast("bigint").alias("total_bytes"))

