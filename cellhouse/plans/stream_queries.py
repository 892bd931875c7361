"""Streaming queries over the supplied tables (U2 per window, W3-W6).

Each runs a real Structured Streaming query over the table's parquet file
(a glob path, so the file source accepts it) with an ``availableNow``
trigger, writes through a file sink or ``foreachBatch`` into the shared
work folder, and returns the read-back result.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bytes import from_bytes, padded_key
from ..model import DELETE_FAMILY, PUT
from ..session import new_path
from ..sources.table import read_table
from ..operators.load import bulk_load
from ..streaming.stateful import live_visible, map_windows
from ..streaming.stream import lookup_results, stream_lookup_files, stream_put, windowed_groups
from .fixtures import (EVENT_FAMILIES, EVENT_SPLITS, SQL_EVENT_CELLS, T_DEL, cents, customer_cells,
                       decoded, event_cells, key_splits, new_table, tbl)
from .registry import register


def stream_of(spark, d, name):
    """A file stream over one supplied table."""
    path = f"{d}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path[:-1] + "[" + path[-1] + "]")


def _newest(src: str) -> str:
    return f"""
SELECT row, family, qualifier, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY row, family, qualifier ORDER BY ts DESC, seq DESC) AS rn
  FROM ({src})) WHERE rn = 1
"""


@register("stream_put_scan", _newest(SQL_EVENT_CELLS))
def q_stream_put_scan(spark, d):
    t = new_table(spark, "stream-put", EVENT_FAMILIES, EVENT_SPLITS)
    q = stream_put(event_cells(stream_of(spark, d, "events")), t, new_path(spark, "ck"))
    q.awaitTermination()
    return decoded(read_table(t))


@register("stream_live_visible", _newest(f"SELECT * FROM ({SQL_EVENT_CELLS}) p WHERE NOT "
                                         f"(p.user_id % 10 = 0 AND p.ts <= {T_DEL})"))
def q_stream_live_visible(spark, d):
    ev = stream_of(spark, d, "events")
    puts = event_cells(ev).select("row", "family", F.encode("qualifier", "UTF-8").alias("qualifier"), "ts",
                                  F.lit(PUT).cast("tinyint").alias("op"), F.encode("value", "UTF-8").alias("value"),
                                  "seq")
    # a row delete per event of the users to delete (repeats are harmless)
    dels = ev.where(F.col("user_id") % 10 == 0).select(
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("row"),
        F.explode(F.array(*[F.lit(f) for f in EVENT_FAMILIES])).alias("family"),
        F.lit(bytearray(b"")).alias("qualifier"), F.lit(T_DEL).cast("bigint").alias("ts"),
        F.lit(DELETE_FAMILY).cast("tinyint").alias("op"), F.lit(None).cast("binary").alias("value"),
        F.col("event_id").alias("seq"))
    out = new_path(spark, "live")

    def each(batch, batch_id):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    q = (live_visible(puts.unionByName(dels)).writeStream.outputMode("update").foreachBatch(each)
         .option("checkpointLocation", new_path(spark, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    upd = spark.read.parquet(out)
    last = Window.partitionBy("row", "family", "qualifier").orderBy(F.col("batch_id").desc())
    cur = upd.withColumn("_rn", F.row_number().over(last)).where((F.col("_rn") == 1) & F.col("present"))
    return cur.select(from_bytes("row").alias("row"), "family", from_bytes("qualifier").alias("qualifier"), "ts",
                      from_bytes("value").alias("value"))


WATERMARK_MS = 3600 * 1000


@register("stream_windowed_groups", f"""
WITH g AS (
  SELECT epoch_us(date_trunc('day', ts) + INTERVAL 1 DAY) // 1000 - 1 AS group_ts, user_id,
         count(*) AS n, CAST(sum(round(value * 100)) AS BIGINT) AS total_cents
  FROM events GROUP BY 1, 2)
SELECT * FROM g WHERE group_ts + 1 <= (SELECT epoch_us(max(ts)) // 1000 FROM events) - {WATERMARK_MS}
""")
def q_stream_windowed_groups(spark, d):
    """Append mode emits a window once the watermark (max event time - 1 h)
    has passed its end; windows still open at the end are not emitted."""
    ev = stream_of(spark, d, "events")
    g = windowed_groups(ev, "user_id", "ts", "1 day",
                        [F.count(F.lit(1)).alias("n"), F.sum(cents("value")).cast("bigint").alias("total_cents")],
                        watermark="1 hour")
    out = new_path(spark, "windows")
    q = (g.select("group_ts", "user_id", "n", "total_cents").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", new_path(spark, "ck")).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema("group_ts bigint, user_id bigint, n bigint, total_cents bigint").parquet(out)



# --- U2 x W3: a user function per user and day, once the day is closed ---------
VISIT = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("gap_micros", T.LongType()),
    T.StructField("running_cents", T.LongType())])


def visits(conf, key, batches):
    """A user's day in order: time since the event before, and cents so far."""
    last, sofar = None, 0
    for b in batches:
        times = b.column("ts")
        before = pa.concat_arrays([pa.array([last], pa.int64()), times.slice(0, len(times) - 1)])
        run = pc.add(pc.cumulative_sum(b.column("cents")), sofar)
        last, sofar = times[-1].as_py(), run[-1].as_py()
        yield pa.RecordBatch.from_arrays([b.column("event_id"), pc.subtract(times, before), run], names=VISIT.names)


@register("stream_map_windows", f"""
WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS t, epoch_us(date_trunc('day', ts) + INTERVAL 1 DAY) // 1000 - 1 AS group_ts,
                  CAST(round(value * 100) AS BIGINT) AS cents FROM events WHERE user_id IS NOT NULL)
SELECT user_id AS key, group_ts, row_number() OVER w - 1 AS "index", event_id, t - lag(t) OVER w AS gap_micros,
       CAST(sum(cents) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_cents
FROM e WHERE group_ts + 1 <= (SELECT epoch_us(max(ts)) // 1000 FROM events) - {WATERMARK_MS}
WINDOW w AS (PARTITION BY user_id, group_ts ORDER BY t, event_id)
""")
def q_stream_map_windows(spark, d):
    ev = stream_of(spark, d, "events").select("event_id", "user_id", "ts", cents("value").alias("cents"))
    out = new_path(spark, "visits")
    q = (map_windows(ev, "user_id", "ts", "1 day", "1 hour", visits, VISIT, order_by=("ts", "event_id"))
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", new_path(spark, "ck"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema("key bigint, group_ts bigint, index bigint, event_id bigint, gap_micros bigint, "
                             "running_cents bigint").parquet(out)


# --- W5: requests of a stream looked up in a table ----------------------------
@register("stream_bulk_get", f"""
SELECT event_id, user_id, c.c_name, c.c_mktsegment, c.c_custkey IS NOT NULL AS found
FROM events LEFT JOIN customer c ON c.c_custkey = user_id WHERE user_id IS NOT NULL
""")
def q_stream_bulk_get(spark, d):
    t = new_table(spark, "stream-get", ["info"], key_splits(spark, d, "customer", "c_custkey"))
    bulk_load(t, customer_cells(tbl(spark, d, "customer")))
    ev = stream_of(spark, d, "events").select("event_id", "user_id", padded_key("user_id").alias("row"))
    out = new_path(spark, "answers")
    stream_lookup_files(ev, t.path, [("info", "c_name", "c_name"), ("info", "c_mktsegment", "c_mktsegment")], out,
                        new_path(spark, "ck")).awaitTermination()
    return lookup_results(spark, out).select("event_id", "user_id", from_bytes("c_name").alias("c_name"),
                                             from_bytes("c_mktsegment").alias("c_mktsegment"), "found")
