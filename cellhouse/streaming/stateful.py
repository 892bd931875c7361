"""Streams with user functions and state per cell (``transformWithState``).

* ``map_windows`` (U2 x W3): a user function per key and event-time window.  Keys
  are dealt over a fixed number of buckets; the rows of a bucket and window are state,
  added part by part as they come.  A timer at the window's end hands the rows of
  each key to the function, once, when the watermark closes the window.
* ``live_visible`` (W6 with deletes): the current cell of each changed column.
  State is a map by qualifier, so a change reads and writes its own column only,
  however many the (row, family) has; a family delete visits its columns.

Both need RocksDB as state store (``with_rocksdb`` sets it for queries started
afterwards), which keeps state on disk and writes changes only.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..model import DELETE_COLUMN, DELETE_FAMILY, DELETE_VERSION, PUT
from ..session import ship_package
from .stream import LIVE_SCHEMA, as_event_time

#: rows of a group handed to the user function at once
CHUNK = 4096
#: buckets that the keys of a window are dealt over
SPREAD = 512
#: bytes of a bucket's rows held at once when a window closes
HOLD_BYTES = 64 << 20


def with_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _arrow(values: pd.Series, kind: pa.DataType) -> pa.Array:
    if values.dtype.kind in "iufb":
        return pa.array(values, kind, from_pandas=True)
    return pa.array(values.astype(object).where(values.notna(), None).tolist(), kind)


class _Windows(StatefulProcessor):
    """Rows of a bucket of keys and one window until its end, as parts in Arrow's
    stream format, in order of arrival."""

    def __init__(self, fn: Callable, conf: dict, rows: T.StructType, out: T.StructType, key: str, order: list[str],
                 hold_bytes: int):
        self.fn, self.conf, self.rows, self.out, self.key, self.order = fn, conf, rows, out, key, order
        self.hold_bytes = hold_bytes

    def init(self, handle: StatefulProcessorHandle) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema

        self.handle, self.kinds = handle, to_arrow_schema(self.rows)
        self.held = handle.getMapState("parts", "part LONG", "rows BINARY")
        self.size = handle.getValueState("size", "parts LONG, bytes LONG")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, size = self.size.get() if self.size.exists() else (0, 0)
        if not n:
            self.handle.registerTimer(int(key[1]))
        for pdf in rows:
            part = pa.RecordBatch.from_arrays([_arrow(pdf.iloc[:, i], f.type) for i, f in enumerate(self.kinds)],
                                              schema=self.kinds)
            self.held.updateValue((n,), (part.serialize().to_pybytes(),))
            n, size = n + 1, size + part.nbytes
        self.size.update((n, size))
        return iter(())

    def parts(self, n: int) -> Iterator[pa.RecordBatch]:
        for i in range(n):
            yield pa.ipc.read_record_batch(pa.py_buffer(self.held.getValue((i,))[0]), self.kinds)

    def groups(self, n: int, size: int) -> Iterator[tuple]:
        """Every key with its rows in batches.  What does not fit ``hold_bytes`` is read
        in several passes, each over the keys whose rows fit; a key too large for that
        is passed on part by part, or held alone if it must be sorted."""
        if size <= self.hold_bytes:
            yield from self.sorted_groups(list(self.parts(n)))
            return
        count: dict = {}
        for part in self.parts(n):
            for k in part.column(self.key).value_counts().to_pylist():
                count[k["values"]] = count.get(k["values"], 0) + k["counts"]
        kind, most = self.kinds.field(self.key).type, max(1, self.hold_bytes * sum(count.values()) // size)
        some, held = [], 0
        for k, rows in count.items():
            if rows > most and not self.order:
                mine = (p.filter(pc.equal(p.column(self.key), pa.scalar(k, kind))) for p in self.parts(n))
                yield k, (p.slice(i, CHUNK) for p in mine for i in range(0, p.num_rows, CHUNK))
                continue
            if some and held + rows > most:
                yield from self.sorted_groups(self.rows_of(pa.array(some, kind), n))
                some, held = [], 0
            some.append(k)
            held += rows
        if some:
            yield from self.sorted_groups(self.rows_of(pa.array(some, kind), n))

    def rows_of(self, keys: pa.Array, n: int) -> list:
        return [p.filter(pc.is_in(p.column(self.key), value_set=keys)) for p in self.parts(n)]

    def sorted_groups(self, parts: list) -> Iterator[tuple]:
        held = pa.Table.from_batches(parts, schema=self.kinds)
        held = held.take(pc.sort_indices(held, sort_keys=[(c, "ascending") for c in (self.key, *self.order)],
                                         null_placement="at_start"))  # stable: equal rows stay in order of arrival
        for rows in held.combine_chunks().to_batches():
            keys = rows.column(self.key)
            cuts = pc.indices_nonzero(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1))).to_pylist()
            starts = [0, *(i + 1 for i in cuts)]
            for k, lo, hi in zip(keys.take(pa.array(starts)).to_pylist(), starts, [*starts[1:], len(keys)]):
                yield k, (rows.slice(i, min(CHUNK, hi - i)) for i in range(lo, hi, CHUNK))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, names, found = int(key[1]), self.out.names[3:], []
        for k, batches in self.groups(*self.size.get()):
            got = self.fn(self.conf, k, batches)
            n = 0
            for item in [got] if isinstance(got, (pa.RecordBatch, pa.Table)) else (got if got is not None else []):
                rows = zip(*(item.column(c).to_pylist() for c in names)) if isinstance(item, (pa.RecordBatch, pa.Table)) else [
                    tuple(item.get(c) for c in names) if isinstance(item, dict) else tuple(item)]
                for r in rows:
                    found.append((k, last, n, *r))
                    n += 1
                    if len(found) == CHUNK:
                        yield self.frame(found)
                        found = []
            if n == 0 and got is not None:
                found.append((k, last, None, *[None] * len(names)))  # an empty result keeps the group
        if found:
            yield self.frame(found)
        self.held.clear()
        self.size.clear()

    def frame(self, rows: list) -> pd.DataFrame:
        return pd.DataFrame({f.name: pd.Series(c, dtype="Int64" if isinstance(f.dataType, T.LongType) else object)
                             for f, c in zip(self.out, zip(*rows))})

    def close(self) -> None:
        pass


def map_windows(stream: DataFrame, key: str, ts: str, size: str, watermark: str, fn: Callable, schema: T.StructType,
                slide: str | None = None, order_by=(), conf: dict | None = None, spread: int = SPREAD,
                hold_bytes: int = HOLD_BYTES) -> DataFrame:
    """``fn(conf, key, batches)`` for every key and event-time window that the
    watermark has closed, as in ``map_partitions``: ``(key, group_ts, index, *schema)``,
    ``group_ts`` the window's last millisecond.  Run in append mode.

    Null keys and rows behind the watermark are dropped.  A group's rows come as
    batches of ``CHUNK``, in order of arrival, or sorted by ``order_by`` (then a group
    is held in memory while its function runs).  State is kept by bucket of keys, not
    by key: a window has ``spread`` buckets at most, which must stay the same for the
    life of a checkpoint, and of each no more than ``hold_bytes`` is in memory."""
    spark = stream.sparkSession
    ship_package(spark)
    with_rocksdb(spark)
    d = as_event_time(stream, ts).withWatermark(ts, watermark)
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    rows = T.StructType([T.StructField(f"{f.name}", T.LongType() if f.name == ts else f.dataType) for f in d.schema])
    # of the time columns only the window keeps the watermark: rows are late, and dropped, when their window is closed
    cols = [F.unix_micros(F.col(ts)).alias(ts) if c == ts else F.col(f"`{c}`") for c in d.columns]
    d = d.where(F.col(key).isNotNull()).select(w.alias("_w"), F.struct(*cols).alias("_r"))
    d = d.select("_r.*", F.window_time("_w").alias("_time"), F.pmod(F.xxhash64(f"_r.`{key}`"), F.lit(spread)).alias("_bucket"),
                 (F.unix_millis("_w.end") - 1).alias("_last"))
    out = T.StructType([T.StructField("key", stream.schema[key].dataType), T.StructField("group_ts", T.LongType()),
                        T.StructField("index", T.LongType()), *schema.fields])
    processor = _Windows(fn, dict(conf or {}), rows, out, key, list(order_by), hold_bytes)
    return d.groupBy("_bucket", "_last").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=out, outputMode="Append", timeMode="EventTime")


# ------------------------------------------------------------------- live view

_CELL = T.StructType([
    T.StructField("col_del", T.LongType()), T.StructField("ver_del", T.ArrayType(T.LongType())),
    T.StructField("ts", T.ArrayType(T.LongType())), T.StructField("seq", T.ArrayType(T.LongType())),
    T.StructField("value", T.ArrayType(T.BinaryType()))])


class _Live(StatefulProcessor):
    """Family delete time and, by qualifier, a column's unmasked versions."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.family = handle.getValueState("family", "del LONG")
        self.columns = handle.getMapState("columns", "qualifier BINARY", _CELL, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        was = self.family.get() if self.family.exists() else None
        gone = now = was[0] if was else None
        changed: dict[bytes, list] = {}  # qualifier -> [col_del, ver_del, puts], read when first touched
        for pdf in rows:
            for q, ts, op, value, seq in zip(*(pdf[c].tolist() for c in ("qualifier", "ts", "op", "value", "seq"))):
                if op == DELETE_FAMILY:
                    now = ts if now is None else max(now, ts)
                    continue
                q = bytes(q)
                c = changed.get(q) or changed.setdefault(q, self.read(q))
                if op == PUT:
                    c[2].append((ts, seq, None if value is None else bytes(value)))
                elif op == DELETE_COLUMN:
                    c[0] = ts if c[0] is None else max(c[0], ts)
                elif op == DELETE_VERSION:
                    c[1].add(ts)
        if now != gone:
            self.family.update((int(now),))
            for (q,) in list(self.columns.keys()):  # a family delete may hide any column
                changed.setdefault(bytes(q), None)
        out = []
        for q in sorted(changed):
            c = changed[q] or self.read(q)
            floor = max((t for t in (now, c[0]) if t is not None), default=None)
            live = [p for p in c[2] if (floor is None or p[0] > floor) and p[0] not in c[1]]
            best = max(live, key=lambda p: p[:2], default=None)
            # masked puts go for good; other versions stay, as a version delete may uncover them
            if live or c[0] is not None or c[1]:
                live.sort(key=lambda p: p[:2])
                self.columns.updateValue((q,), (
                    c[0], sorted(v for v in c[1] if floor is None or v > floor), *([p[i] for p in live] for i in range(3))))
            elif self.columns.containsKey((q,)):
                self.columns.removeKey((q,))
            out.append((*key, q, best[0] if best else None, best[2] if best else None, best is not None))
            if len(out) == CHUNK:
                yield self.frame(out)
                out = []
        if out:
            yield self.frame(out)

    def read(self, q: bytes) -> list:
        c = self.columns.getValue((q,)) if self.columns.exists() else None
        return [None, set(), []] if c is None else [c[0], set(c[1]), [
            (t, s, None if v is None else bytes(v)) for t, s, v in zip(c[2], c[3], c[4])]]

    @staticmethod
    def frame(rows: list) -> pd.DataFrame:
        return pd.DataFrame({f.name: pd.Series(c, dtype="Int64" if isinstance(f.dataType, T.LongType) else object)
                             for f, c in zip(LIVE_SCHEMA, zip(*rows))})

    def close(self) -> None:
        pass


def live_visible(cell_stream: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """W6 with deletes: run in update mode; each output row is the current visible
    newest cell of a changed column (``present`` false when hidden).  ``ttl_ms``: a
    column not changed for so long (processing time) leaves the state."""
    ship_package(cell_stream.sparkSession)
    with_rocksdb(cell_stream.sparkSession)
    cells = cell_stream.select("row", "family", "qualifier", F.col("ts").cast("long").alias("ts"), "op", "value",
                               F.col("seq").cast("long").alias("seq"))
    return cells.groupBy("row", "family").transformWithStateInPandas(
        statefulProcessor=_Live(ttl_ms), outputStructType=LIVE_SCHEMA, outputMode="Update",
        timeMode="ProcessingTime" if ttl_ms else "None")
