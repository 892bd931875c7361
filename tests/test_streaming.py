"""Streams agree with the batch operators on the same input."""

import glob
import os
import random
import sys
import time

from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellhouse import new_path, read_table
from cellhouse.operators.lookup import bulk_get
from cellhouse.operators.mutate import bulk_put
from cellhouse.session import local_path
from cellhouse.streaming import (live_latest, live_visible, lookup_results, map_windows, stream_lookup, stream_lookup_files,
                                 stream_put, windowed_groups)
from cellhouse.streaming.stream import batch_committed, _tag
from cellhouse.plans.fixtures import event_cells

from conftest import SF_SMALL

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests


def _event_files(spark, n_files=3):
    src = new_path(spark, "events-src")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(n_files).write.parquet(src)
    return src


def forget_last_batch(ck):
    """Remove the commit of the last micro-batch, so that it runs again."""
    commits = sorted(glob.glob(local_path(ck) + "/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(commits[-1])
    crc = os.path.join(os.path.dirname(commits[-1]), f".{os.path.basename(commits[-1])}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    return commits[-1]


def test_stream_put_equals_batch_and_replay_is_idempotent(spark, tmp_table):
    src = _event_files(spark)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    t = tmp_table(["click", "error", "purchase", "signup", "view"], splits=["2", "5"])
    ck = new_path(spark, "ck")
    q = stream_put(event_cells(stream), t, ck)
    q.awaitTermination(300)
    t_batch = tmp_table(["click", "error", "purchase", "signup", "view"], splits=["2", "5"])
    bulk_put(t_batch, event_cells(spark.read.parquet(src)))
    snap = lambda tb: sorted(tuple(r) for r in read_table(tb, versions=None).select(
        F.hex("row"), "family", "ts", F.hex("value")).collect())
    assert snap(t) == snap(t_batch)
    loads = len(t.committed_loads())
    assert loads >= 3
    assert batch_committed(t, f"stream:{_tag(ck)}:0")
    # replay: without its commit file the last micro-batch runs again, and adds nothing
    last = forget_last_batch(ck)
    q = stream_put(event_cells(stream), t, ck)
    q.awaitTermination(300)
    assert os.path.exists(last)
    assert len(t.committed_loads()) == loads and snap(t) == snap(t_batch)


def test_stream_put_merges_small_files(spark, tmp_table):
    src = _event_files(spark, 5)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    t = tmp_table(["click", "error", "purchase", "signup", "view"])
    stream_put(event_cells(stream), t, new_path(spark, "ck"), merge_over=2).awaitTermination(300)
    per = {}
    for e in t.live_entries():
        per[e["family"], e["region"]] = per.get((e["family"], e["region"]), 0) + e["n_small_files"]
    assert per and max(per.values()) <= 3
    assert read_table(t, versions=None).count() == read_table_of(spark, tmp_table, src).count()


def read_table_of(spark, tmp_table, src):
    t = tmp_table(["click", "error", "purchase", "signup", "view"])
    bulk_put(t, event_cells(spark.read.parquet(src)))
    return read_table(t, versions=None)


def test_live_visible_with_deletes_of_every_scope(spark, tmp_table):
    rows = [("r", "f", "q", 1, "a", 4), ("r", "f", "q", 3, "b", 4), ("r", "f", "p", 2, "c", 4), ("r", "f", "q", 3, None, 8),
            ("s", "f", "q", 5, "d", 4), ("s", "f", "q", 5, None, 12), ("s", "f", "q", 6, "e", 4), ("s", "f", "p", 4, "x", 4),
            ("t", "f", "q", -5, "n", 4), ("t", "f", "", 0, None, 14), ("t", "f", "", -9, None, 14), ("t", "f", "p", 1, "y", 4)]
    src = new_path(spark, "cells")
    for i, r in enumerate(rows):  # one micro-batch each, in this order
        spark.createDataFrame([(*r, i)], "row string, family string, qualifier string, ts long, value string, op int, seq long"
                              ).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.02)
    schema = "row string, family string, qualifier string, ts long, value string, op int, seq long"
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).parquet(src)
    cells = raw.select(F.encode("row", "UTF-8").alias("row"), "family", F.encode("qualifier", "UTF-8").alias("qualifier"),
                       "ts", F.col("op").cast("tinyint").alias("op"), F.encode("value", "UTF-8").alias("value"), "seq")
    batches = []
    q = live_visible(cells).writeStream.outputMode("update").foreachBatch(
        lambda df, i: batches.append(df.collect())).option("checkpointLocation", new_path(spark, "ck")).trigger(
        availableNow=True).start()
    q.awaitTermination(300)
    final = {}
    for b in batches:
        for r in b:
            final[bytes(r.row).decode(), bytes(r.qualifier).decode()] = (r.ts, bytes(r.value).decode()) if r.present else None
    assert {k: v for k, v in final.items() if v} == {("r", "q"): (1, "a"), ("r", "p"): (2, "c"), ("s", "q"): (6, "e"),
                                                    ("s", "p"): (4, "x"), ("t", "p"): (1, "y")}


def test_windowed_groups_stream_equals_batch(spark):
    src = _event_files(spark)
    schema = spark.read.parquet(src).schema
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("value").alias("v")]
    stream = spark.readStream.schema(schema).parquet(src)
    g = windowed_groups(stream, "user_id", "ts", "1 day", aggs, watermark="1 hour")
    name = f"wg_{int(time.time() * 1000)}"
    q = g.writeStream.outputMode("append").format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = sorted((r.group_ts, r.user_id, r.n) for r in spark.sql(f"SELECT * FROM {name}").collect())
    batch = windowed_groups(spark.read.parquet(src), "user_id", "ts", "1 day", aggs)
    exp = sorted((r.group_ts, r.user_id, r.n) for r in batch.collect())
    # append mode emits windows closed by the watermark; all emitted ones agree with batch
    assert got and set(got) <= set(exp)


def test_live_latest_and_live_visible(spark, tmp_table):
    src = _event_files(spark)
    schema = spark.read.parquet(src).schema
    stream = event_cells(spark.readStream.schema(schema).parquet(src))
    cells = stream.select("row", "family",
                          F.encode("qualifier", "UTF-8").alias("qualifier"), "ts",
                          F.encode("value", "UTF-8").alias("value"), "seq", F.lit(4).cast("tinyint").alias("op"))
    name = f"live_{int(time.time() * 1000)}"
    q = live_latest(cells).writeStream.outputMode("update").format("memory").queryName(name) \
        .trigger(availableNow=True).start()
    q.awaitTermination(300)
    t = tmp_table(["click", "error", "purchase", "signup", "view"])
    bulk_put(t, event_cells(spark.read.parquet(src)))
    exp = sorted((bytes(r.row), r.family, r.ts, bytes(r.value)) for r in read_table(t).collect())
    got_rows = spark.sql(f"SELECT * FROM {name}").collect()
    latest = {}
    for r in got_rows:
        k = (bytes(r.row), r.family)
        if k not in latest or r.ts > latest[k][0]:
            latest[k] = (r.ts, bytes(r.value))
    assert sorted((k[0], k[1], v[0], v[1]) for k, v in latest.items()) == exp

    name2 = f"vis_{int(time.time() * 1000)}"
    q2 = live_visible(cells).writeStream.outputMode("update").format("memory").queryName(name2) \
        .trigger(availableNow=True).start()
    q2.awaitTermination(300)
    final = {}
    for r in spark.sql(f"SELECT * FROM {name2}").collect():
        final[(bytes(r.row), r.family)] = (r.ts, None if r.value is None else bytes(r.value))
    assert sorted((k[0], k[1], v[0], v[1]) for k, v in final.items()) == exp


def test_stream_lookup(spark, tmp_table):
    t = tmp_table(["click", "error", "purchase", "signup", "view"])
    bulk_put(t, event_cells(spark.read.parquet(f"{SF_SMALL}/events.parquet")))
    src = new_path(spark, "req")
    spark.range(200).select(F.col("id").cast("string").alias("row")).repartition(2).write.parquet(src)
    out = []
    q = stream_lookup(spark.readStream.schema("row string").parquet(src), t.path, [("click", "value", "v")],
                      lambda df, bid: out.append(df.collect()), new_path(spark, "ck"))
    q.awaitTermination(300)
    rows = [r for b in out for r in b]
    batch = bulk_get(spark.read.parquet(src), t, [("click", "value", "v")]).collect()
    assert sorted((r.row, r.found) for r in rows) == sorted((r.row, r.found) for r in batch)


def test_stream_lookup_files_are_replaced_on_replay(spark, tmp_table):
    t = tmp_table(["click", "error", "purchase", "signup", "view"])
    bulk_put(t, event_cells(spark.read.parquet(f"{SF_SMALL}/events.parquet")))
    src, out, ck = new_path(spark, "req"), new_path(spark, "out"), new_path(spark, "ck")
    spark.range(300).select(F.col("id").cast("string").alias("row")).repartition(3).write.parquet(src)
    stream = spark.readStream.schema("row string").option("maxFilesPerTrigger", 1).parquet(src)

    def run():
        stream_lookup_files(stream, t.path, [("click", "value", "v")], out, ck).awaitTermination(300)
        return sorted((r.row, r.found, r.v) for r in lookup_results(spark, out).collect())

    want = sorted((r.row, r.found, r.v) for r in bulk_get(spark.read.parquet(src), t, [("click", "value", "v")]).collect())
    assert run() == want
    forget_last_batch(ck)
    assert run() == want


def _visits(conf, key, batches):
    n = s = 0
    for b in batches:
        for r in b.to_pylist():
            n, s = n + 1, s + r["v"]
            yield (r["v"], s)


SUMS = T.StructType([T.StructField("v", T.LongType()), T.StructField("sofar", T.LongType())])


def _files(spark, batches, schema):
    src = new_path(spark, "src")
    for rows in batches:  # one micro-batch each, in this order
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.02)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)


def _run_windows(spark, stream, **kw):
    out = new_path(spark, "out")
    (map_windows(stream, "k", "ts", "10 seconds", "5 seconds", kw.pop("fn", _visits), kw.pop("schema", SUMS), **kw)
     .writeStream.format("parquet").option("path", out).option("checkpointLocation", new_path(spark, "ck"))
     .outputMode("append").trigger(availableNow=True).start()).awaitTermination(300)
    return sorted(((r.key, r.group_ts, r["index"], r.v, r.sofar) for r in spark.read.parquet(out).collect()), key=str)


def test_map_windows_calls_the_function_once_per_closed_window(spark):
    at = lambda sec, k, v: (k, sec * 1_000_000, v)
    raw = [[at(1, 1, 10), at(2, 1, 5), at(3, 2, 1), at(4, None, 9)], [at(12, 1, 7), at(0, 1, 1)],
           [at(18, 2, 3), at(9, 1, 2)],  # behind 12 s, but the watermark is at 7 s and the window open
           [at(30, 1, 100)],  # the watermark is at 13 s: the first windows are closed in this batch
           [at(40, 3, 8), at(3, 1, 77)], [at(3, 5, 78)]]  # rows of closed windows go
    stream = _files(spark, raw, "k long, us long, v long").select("k", F.timestamp_micros("us").alias("ts"), "v")
    got = _run_windows(spark, stream, order_by=("v",))
    # the watermark ends at 35 s: windows up to 30 s are closed
    want = [(1, 9999, 0, 1, 1), (1, 9999, 1, 2, 3), (1, 9999, 2, 5, 8), (1, 9999, 3, 10, 18), (2, 9999, 0, 1, 1),
            (1, 19999, 0, 7, 7), (2, 19999, 0, 3, 3)]
    assert got == sorted(want, key=str)


def test_map_windows_keeps_empty_results_and_drops_none(spark):
    def some(conf, key, batches):
        rows = sum(b.num_rows for b in batches)
        return None if key == 2 else [] if key == 3 else [(rows, 0)]

    raw = [[(k, i * 1000, i) for i in range(50) for k in (1, 2, 3)], [(1, 60_000_000, 1)], [(1, 61_000_000, 1)]]
    stream = _files(spark, raw, "k long, us long, v long").select("k", F.timestamp_micros("us").alias("ts"), "v")
    assert _run_windows(spark, stream, fn=some) == sorted([(1, 9999, 0, 50, 0), (3, 9999, None, None, None)], key=str)


def test_live_visible_reads_changed_columns_only(spark):
    n = 20_000
    schema = "row string, family string, qualifier string, ts long, value string, op int, seq long"
    first = [("r", "f", f"q{i}", 1, "a", 4, i) for i in range(n)]
    later = [[("r", "f", "q5", 2, "b", 4, n + j)] for j in range(3)]
    cells = _files(spark, [first, *later], schema).select(
        F.encode("row", "UTF-8").alias("row"), "family", F.encode("qualifier", "UTF-8").alias("qualifier"), "ts",
        F.col("op").cast("tinyint").alias("op"), F.encode("value", "UTF-8").alias("value"), "seq")
    sizes, q = [], None
    q = live_visible(cells).writeStream.outputMode("update").foreachBatch(
        lambda df, i: sizes.append(df.count())).option("checkpointLocation", new_path(spark, "ck")).trigger(
        availableNow=True).start()
    q.awaitTermination(600)
    assert sizes[:4] == [n, 1, 1, 1]
    took = [p["durationMs"]["addBatch"] for p in q.recentProgress if p["numInputRows"]]
    assert max(took[1:4]) < took[0]  # not by the columns the row has


def test_live_visible_equals_a_read_of_the_log(spark, tmp_table):
    from cellhouse.operators.mutate import apply_mutations

    r = random.Random(2)
    rows = [(r.choice("xyz"), "family", r.choice("abcd"), r.randrange(12), f"v{i}" if r.random() < 0.9 else None,
             r.choice([4, 4, 4, 4, 8, 12, 14]), i) for i in range(300)]
    rows = [(*x[:2], "", *x[3:]) if x[5] == 14 else x for x in rows]
    schema = "row string, family string, qualifier string, ts long, value string, op int, seq long"

    def cells(df):
        return df.select(F.encode("row", "UTF-8").alias("row"), "family", F.encode("qualifier", "UTF-8").alias("qualifier"),
                         "ts", F.col("op").cast("tinyint").alias("op"),
                         F.when(F.col("op") == 4, F.encode("value", "UTF-8")).alias("value"), "seq")

    batches, out = [rows[i:i + 60] for i in range(0, 300, 60)], []
    live_visible(cells(_files(spark, batches, schema))).writeStream.outputMode("update").foreachBatch(
        lambda df, i: out.append(df.collect())).option("checkpointLocation", new_path(spark, "ck")).trigger(
        availableNow=True).start().awaitTermination(300)
    final = {}
    for b in out:
        for x in b:
            final[bytes(x.row), bytes(x.qualifier)] = (x.ts, x.value and bytes(x.value)) if x.present else None
    t = tmp_table(["family"])
    apply_mutations(t, cells(spark.createDataFrame(rows, schema)))
    want = {(bytes(x.row), bytes(x.qualifier)): (x.ts, x.value and bytes(x.value)) for x in read_table(t).collect()}
    assert {k: v for k, v in final.items() if v} == want


def test_map_windows_state_is_kept_by_bucket_of_keys(spark):
    """Many keys share a state; none of their rows, nulls or order is lost, however little is held at once."""
    def rows(conf, key, batches):
        for b in batches:
            assert b.num_rows <= 4096
            yield from zip(*(b.column(c).to_pylist() for c in ("id", "v", "s")))

    raw = [[(k, i * 1000, None if i % 3 == 0 else -i, f"s{k}", i) for k in range(300) for i in range(5)]
           + [(7, 9_000_000, j, None, 100 + j) for j in range(5000)],
           [(k, 20_000_000, 1, "x", 0) for k in range(300)], [(1, 60_000_000, 1, "y", 1)], [(1, 61_000_000, 1, "z", 1)]]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.LongType()), T.StructField("s", T.StringType())])
    want = {(k, 9999): [(i, None if i % 3 == 0 else -i, f"s{k}") for i in range(5)] for k in range(300)}
    want[7, 9999] += [(100 + j, j, None) for j in range(5000)]
    want |= {(k, 29999): [(0, 1, "x")] for k in range(300)}
    for order, hold in (((), 1 << 26), ((), 20_000), (("v", "id"), 1 << 26), (("v", "id"), 20_000)):
        stream = _files(spark, raw, "k long, us long, v long, s string, id long").select(
            "k", F.timestamp_micros("us").alias("ts"), "v", "s", "id")
        out = new_path(spark, "out")
        q = (map_windows(stream, "k", "ts", "10 seconds", "5 seconds", rows, schema, order_by=order, spread=3, hold_bytes=hold)
             .writeStream.format("parquet").option("path", out).option("checkpointLocation", new_path(spark, "ck"))
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination(300)
        got = {}
        for r in sorted(spark.read.parquet(out).collect(), key=lambda r: r["index"]):
            got.setdefault((r.key, r.group_ts), []).append((r.id, r.v, r.s))
        by = (lambda r: (r[1] is not None, r[1], r[0])) if order else (lambda r: r[0])
        assert {k: sorted(v, key=by) if not order else v for k, v in got.items()} == {k: sorted(v, key=by) for k, v in want.items()}
        # 3 buckets and two windows, where each of 600 keys and windows was a state
        states = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
        assert 0 < max(states) < 100
