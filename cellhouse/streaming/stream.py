"""Streaming counterparts.

* ``stream_put`` (W4): a mutation stream into a table through
  ``foreachBatch``; each micro-batch is one load tagged with the query's
  checkpoint id and batch id, and a replayed batch whose load is already
  committed is skipped -- replay after a failure is idempotent.
* ``stream_lookup`` (W5): requests looked up per micro-batch with
  ``bulk_get`` against the table *as published at that batch*;
  ``stream_lookup_files`` keeps the results in a folder per batch, which a
  replay of the batch replaces.
* ``stream_lookup_static`` (W5): stream-static left join against a snapshot.
* ``windowed_groups`` (W2/W3): watermark + event-time windows + key.
* ``live_latest`` (W6): newest value per column of a put stream (update mode,
  partial aggregation per micro-batch).
* in ``stateful``: ``map_windows`` (U2 per window) and ``live_visible`` (W6 with
  deletes).

``timestamp_ntz`` inputs become the ``timestamp`` whose UTC wall clock they
hold (independent of the session time zone) because watermarks need a
``timestamp``.  Rows behind
the watermark are dropped by Spark.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bytes import ntz_to_instant
from ..operators.load import bulk_load
from ..operators.lookup import bulk_get
from ..operators.visibility import latest_value
from ..sources.table import CellTable, open_table


def _tag(checkpoint: str) -> str:
    return hashlib.sha1(checkpoint.encode()).hexdigest()[:12]


def batch_committed(table: CellTable, kind: str) -> bool:
    if not table.committed_loads():
        return False
    return table.manifest().where(F.col("kind") == F.lit(kind)).limit(1).count() > 0


def stream_put(stream: DataFrame, table: CellTable, checkpoint: str, trigger: dict | None = None,
               query_name: str | None = None, merge_over: int | None = None):
    """Write a cell stream (``row, family, qualifier, value[, ts, op, seq]``)
    into ``table``; returns the started ``StreamingQuery``.  ``merge_over``:
    groups that gather more small files than this are merged as batches come."""
    path, tag = table.path, _tag(checkpoint)

    def each(batch: DataFrame, batch_id: int):
        t = open_table(batch.sparkSession, path)
        kind = f"stream:{tag}:{batch_id}"
        if batch_committed(t, kind):
            return  # replay of a committed micro-batch
        bulk_load(t, batch, kind=kind, merge_over=merge_over)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def stream_lookup(stream: DataFrame, table_path: str, columns, sink, checkpoint: str, row: str = "row",
                  trigger: dict | None = None):
    """Per micro-batch ``bulk_get`` against the currently published table;
    ``sink(result_df, batch_id)`` receives each batch's results."""

    def each(batch: DataFrame, batch_id: int):
        t = open_table(batch.sparkSession, table_path)
        sink(bulk_get(batch, t, columns, row=row), batch_id)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def stream_lookup_files(stream: DataFrame, table_path: str, columns, out: str, checkpoint: str, row: str = "row",
                        trigger: dict | None = None):
    """W5 with files: the results of a micro-batch are parquet files in
    ``out/batch=<id>``.  A replay after a failure overwrites its own folder, so each
    request is answered once in ``lookup_results(spark, out)``."""
    def sink(result: DataFrame, batch_id: int):
        result.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return stream_lookup(stream, table_path, columns, sink, checkpoint, row, trigger)


def lookup_results(spark, out: str) -> DataFrame:
    """What ``stream_lookup_files`` has answered so far."""
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*").drop("batch")


def stream_lookup_static(stream: DataFrame, snapshot: DataFrame, row: str = "row") -> DataFrame:
    """Stream-static left join with a wide snapshot (``row`` + value
    columns, e.g. from ``wide_rows``); every request is kept."""
    return stream.join(snapshot, row, "left")


def as_event_time(df: DataFrame, col: str) -> DataFrame:
    """Watermarks need TIMESTAMP: a TIMESTAMP_NTZ column becomes the instant
    whose UTC wall clock it holds, so windows fall on the same boundaries
    as the batch form whatever the session time zone."""
    t = df.schema[col].dataType
    if isinstance(t, T.TimestampNTZType):
        return df.withColumn(col, ntz_to_instant(F.col(col)))
    return df


def windowed_groups(df: DataFrame, key: str, ts: str, size: str, aggs, slide: str | None = None,
                    watermark: str | None = None, session_gap: str | None = None) -> DataFrame:
    """Group per event-time window and key.  ``group_ts`` is the
    window's last millisecond (its max timestamp).  Tumbling by default,
    sliding with ``slide``, session windows with ``session_gap``."""
    d = as_event_time(df, ts)
    if watermark:
        d = d.withWatermark(ts, watermark)
    if session_gap:
        w = F.session_window(ts, session_gap)
    elif slide:
        w = F.window(ts, size, slide)
    else:
        w = F.window(ts, size)
    g = d.groupBy(w.alias("w"), key).agg(*aggs)
    return g.withColumn("group_ts", F.unix_millis(F.col("w.end")) - F.lit(1))


def live_latest(put_stream: DataFrame) -> DataFrame:
    """W6 (puts only): newest value per column; run in ``update`` mode."""
    return latest_value(put_stream)


LIVE_SCHEMA = T.StructType([
    T.StructField("row", T.BinaryType()), T.StructField("family", T.StringType()),
    T.StructField("qualifier", T.BinaryType()), T.StructField("ts", T.LongType()),
    T.StructField("value", T.BinaryType()), T.StructField("present", T.BooleanType()),
])
