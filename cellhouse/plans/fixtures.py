"""Mappings from the supplied tables to cells, shared by the registered
queries, with the DuckDB text of the same mappings for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bytes import KEY_DIGITS, epoch_millis, padded_key
from ..session import new_path
from ..sources.table import create_table

# --- fixed values -----------------------------------------------------------
# Region split keys of the tables built from events (user id as text).
EVENT_SPLITS = ["2", "5", "8"]
# Start keys without the empty key, to exercise the "below the first start" case.
PROBE_STARTS = [f"{k:019d}" for k in (1000, 3000, 5000, 9000, 13000)]
# Regions of the tables built from order or customer keys.
N_REGIONS = 8
ORDER_FAMILIES = ["date", "price", "status"]
EVENT_FAMILIES = ["click", "error", "purchase", "signup", "view"]
# Time of the tombstones written over the events table: 2024-01-15 00:00 UTC.
T_DEL = 1705276800000
# A tombstone time after every put of the orders tables: 2100-01-01 00:00 UTC.
T_FUTURE = 4102444800000
# Row keys of lookups that are meant to miss are shifted by this much.
MISS_SHIFT = 1000000
# ---------------------------------------------------------------------------


def tbl(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def key_splits(spark: SparkSession, d: str, name: str = "orders", key: str = "o_orderkey") -> list[str]:
    """Split keys that cut the key range of a table into ``N_REGIONS`` even
    parts, whatever its scale (one aggregate over the key column)."""
    top = tbl(spark, d, name).agg(F.max(key)).first()[0]
    n = 0 if top is None else top + 1
    return [f"{i * n // N_REGIONS:0{KEY_DIGITS}d}" for i in range(1, N_REGIONS)] if n >= N_REGIONS else []


def cents(c) -> F.Column:
    return F.round(F.col(c) * F.lit(100)).cast("bigint")


def order_cells(o: DataFrame) -> DataFrame:
    """orders -> cells: row = text key; families status / price / date."""
    cells = F.array(
        F.struct(F.lit("status").alias("family"), F.lit("o_orderstatus").alias("qualifier"),
                 F.col("o_orderstatus").alias("value")),
        F.struct(F.lit("price").alias("family"), F.lit("o_totalprice").alias("qualifier"),
                 F.format_string("%.2f", "o_totalprice").alias("value")),
        F.struct(F.lit("date").alias("family"), F.lit("o_orderdate").alias("qualifier"),
                 F.date_format("o_orderdate", "yyyy-MM-dd").alias("value")),
    )
    return o.select(
        padded_key("o_orderkey").alias("row"),
        epoch_millis("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("seq"),
        F.explode(cells).alias("c"),
    ).select("row", "c.family", "c.qualifier", "ts", "c.value", "seq")


def customer_cells(c: DataFrame) -> DataFrame:
    """customer -> cells: row = text key; family info; ts 0."""
    cells = F.array(
        F.struct(F.lit("c_name").alias("qualifier"), F.col("c_name").alias("value")),
        F.struct(F.lit("c_nationkey").alias("qualifier"), F.col("c_nationkey").cast("string").alias("value")),
        F.struct(F.lit("c_acctbal").alias("qualifier"), F.format_string("%.2f", "c_acctbal").alias("value")),
        F.struct(F.lit("c_mktsegment").alias("qualifier"), F.col("c_mktsegment").alias("value")),
    )
    return c.select(padded_key("c_custkey").alias("row"), F.col("c_custkey").alias("seq"),
                    F.explode(cells).alias("x")).select(
        "row", F.lit("info").alias("family"), "x.qualifier", F.lit(0).cast("bigint").alias("ts"), "x.value", "seq")


def event_cells(e: DataFrame, value=None) -> DataFrame:
    """events -> cells: row = user id text, family = event type, qualifier
    ``value``, ts = event time (ms), seq = event id."""
    v = value if value is not None else F.format_string("%.2f", "value")
    return e.select(
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("row"),
        F.col("event_type").alias("family"),
        F.lit("value").alias("qualifier"),
        epoch_millis("ts").alias("ts"),
        v.alias("value"),
        F.col("event_id").alias("seq"),
    )


def thin_line_row() -> F.Column:
    """Row key of a lineitem thin-row element: the order key as text."""
    return padded_key("l_orderkey")


def thin_line_cells() -> F.Column:
    """Cells of a lineitem thin-row element (one element per line): price
    and quantity under a qualifier unique within the order."""
    q = F.concat_ws(":", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd"),
                    F.col("l_quantity").cast("bigint").cast("string"))
    return F.array(
        F.struct(F.lit("line").alias("family"), F.concat(q, F.lit(":p")).alias("qualifier"),
                 F.format_string("%.2f", "l_extendedprice").alias("value")),
        F.struct(F.lit("line").alias("family"), F.concat(q, F.lit(":q")).alias("qualifier"),
                 F.col("l_quantity").cast("bigint").cast("string").alias("value")),
    )


def new_table(spark: SparkSession, name: str, families, splits, **kw):
    return create_table(spark, new_path(spark, name), families, splits, **kw)


def decoded(df: DataFrame, with_ts: bool = True) -> DataFrame:
    cols = [F.decode("row", "UTF-8").alias("row"), "family", F.decode("qualifier", "UTF-8").alias("qualifier")]
    if with_ts:
        cols.append("ts")
    cols.append(F.decode("value", "UTF-8").alias("value"))
    return df.select(*cols)


# --- DuckDB text of the same mappings ---------------------------------------
def sql_key(e: str) -> str:
    return f"lpad(CAST({e} AS VARCHAR), {KEY_DIGITS}, '0')"


SQL_ORDER_CELLS = f"""
  SELECT {sql_key('o_orderkey')} AS row, 'status' AS family, 'o_orderstatus' AS qualifier,
         epoch_us(o_orderdate) // 1000 AS ts, o_orderstatus AS value, o_orderkey FROM orders
  UNION ALL
  SELECT {sql_key('o_orderkey')}, 'price', 'o_totalprice', epoch_us(o_orderdate) // 1000,
         printf('%.2f', o_totalprice), o_orderkey FROM orders
  UNION ALL
  SELECT {sql_key('o_orderkey')}, 'date', 'o_orderdate', epoch_us(o_orderdate) // 1000,
         strftime(o_orderdate, '%Y-%m-%d'), o_orderkey FROM orders
"""

SQL_CUSTOMER_CELLS = f"""
  SELECT {sql_key('c_custkey')} AS row, 'info' AS family, 'c_name' AS qualifier, c_name AS value FROM customer
  UNION ALL SELECT {sql_key('c_custkey')}, 'info', 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT {sql_key('c_custkey')}, 'info', 'c_acctbal', printf('%.2f', c_acctbal) FROM customer
  UNION ALL SELECT {sql_key('c_custkey')}, 'info', 'c_mktsegment', c_mktsegment FROM customer
"""

SQL_EVENT_CELLS = """
  SELECT CAST(user_id AS VARCHAR) AS row, event_type AS family, 'value' AS qualifier,
         epoch_us(ts) // 1000 AS ts, printf('%.2f', value) AS value, event_id AS seq, user_id FROM events
"""


def sql_region(key_expr: str, starts) -> str:
    lst = ", ".join(f"'{s}'" for s in starts)
    return f"CAST(len(list_filter([{lst}], lambda x: x <= {key_expr})) - 1 AS INTEGER)"


def sql_order_region(key: str) -> str:
    """Region of an order key (a number) under ``key_splits`` of orders."""
    cuts = [f"{i} * (SELECT max(o_orderkey) + 1 FROM orders) // {N_REGIONS}" for i in range(1, N_REGIONS)]
    return "CAST(" + " + ".join(f"CAST({key} >= {c} AS INTEGER)" for c in cuts) + " AS INTEGER)"


def sql_java_split(line: str) -> str:
    return (f"(CASE WHEN {line} = '' THEN [''] WHEN rtrim({line}, ' ') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({line}, ' '), ' ') END)")


SQL_LINES = r"SELECT doc_id, unnest(string_split_regex(text, '\r\n|\n|\r')) AS line FROM documents"
