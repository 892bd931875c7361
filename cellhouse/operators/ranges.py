"""Keyed work on hot keys: rows sorted over even ranges, a key's run cut where a
range ends.

A *piece* is what one range holds of one key.  Only the first and the last key of
a range can go on in another, so at most two pieces a range belong to split keys;
what the driver sees of them (bounds, carries, counts) is bounded by the ranges.

* ``scan_partitions``: a parallel scan.  Each piece of a split key is folded to a
  carry, carries are combined in range order, and the function runs on every
  piece with the carry of all pieces before it.
* ``numbered_values``: places inside each key.  Keys of ordinary size are numbered
  by a window; hot keys by their place in the ranges.
"""

from __future__ import annotations

import itertools
from typing import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_root

RANGE, PLACE, TIE, PIECE_KEY = "_range", "_place", "_tie", "_piece_key"
#: a key with more rows than this many ranges' worth is hot
HOT_RANGES = 2


def even_ranges(df: DataFrame, *order, n: int | None = None) -> DataFrame:
    """``df`` in ``order`` over ``n`` ranges of about equal rows, however often a key
    occurs (equal rows are cut by arrival).  ``RANGE`` is the range, ``PLACE`` ascends
    in it.  Checkpointed in the shared folder, so every pass sees the same ranges."""
    spark = df.sparkSession
    work_root(spark)  # make sure a checkpoint folder is set
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumn(TIE, F.monotonically_increasing_id())
    rows = rows.repartitionByRange(n, *order, TIE).sortWithinPartitions(*order, TIE).drop(TIE)
    return rows.withColumn(RANGE, F.spark_partition_id()).withColumn(
        PLACE, F.monotonically_increasing_id()).checkpoint(eager=True)


def same_key(k):
    """NaN is one key."""
    return k if k == k else "nan"


def split_pieces(ranged: DataFrame, key: str) -> list[tuple]:
    """``(range, key, number, of)`` of the pieces of all keys that span ranges."""
    ends = ranged.groupBy(RANGE).agg(F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
    runs: dict = {}
    for r in sorted(ends, key=lambda r: r[RANGE]):
        for k in [r["lo"]] if same_key(_plain(r["lo"])) == same_key(_plain(r["hi"])) else [r["lo"], r["hi"]]:
            runs.setdefault(same_key(_plain(k)), []).append((r[RANGE], _plain(k)))
    return [(r, k, i, len(run)) for run in runs.values() if len(run) > 1 for i, (r, k) in enumerate(run)]


def _plain(k):
    return bytes(k) if isinstance(k, bytearray) else k


def _piece_table(spark, pieces: list[tuple], key_type: T.DataType, *more: T.StructField) -> DataFrame:
    """Pieces as a small table: at most two rows a range."""
    return spark.createDataFrame(pieces, T.StructType([
        T.StructField(RANGE, T.IntegerType()), T.StructField(PIECE_KEY, key_type), *more]))


def scan_partitions(keyed: DataFrame, key: str, fn: Callable, schema: T.StructType, carry: Callable, combine: Callable,
                    carry_schema: T.StructType, runner: Callable, conf: dict, order_by=(),
                    n_ranges: int | None = None) -> DataFrame:
    """The parallel scan behind ``map_partitions(..., carry=, combine=)``: rows with a
    key column ``key``; ``runner(fn, schema, key_type, with_index)`` makes a function
    of Arrow batches that calls ``fn(conf, key, batches)`` for each run of a key."""
    spark = keyed.sparkSession
    key_type = keyed.schema[key].dataType
    ranged = even_ranges(keyed, key, *order_by, n=n_ranges).drop(PLACE)
    pieces = split_pieces(ranged, key)
    before: dict = {}
    if pieces:
        # the last piece of a key is carried nowhere
        carried = _piece_table(spark, [p[:2] for p in pieces if p[2] < p[3] - 1], key_type)
        rows = ranged.join(F.broadcast(carried.withColumnRenamed(PIECE_KEY, key)), [RANGE, key], "left_semi")

        def fold(conf, k, batches):
            first = next(batches)
            r = first.column(RANGE)[0].as_py()
            state = carry(conf, k, (b.drop_columns([RANGE]) for b in itertools.chain([first], batches)))
            return None if state is None else [(r, *state)]

        folded = T.StructType([T.StructField(RANGE, T.IntegerType()), *carry_schema.fields])
        kinds = T.StructType([T.StructField(key, key_type), *folded.fields])
        got = rows.select(*ranged.columns).mapInArrow(runner(fold, folded, key_type, False), kinds).collect()
        carries = {(r[RANGE], same_key(_plain(r[key]))): tuple(r)[2:] for r in got}
        state = None
        for r, k, i, _ in pieces:  # a key's pieces follow each other in range order
            state = None if i == 0 else state
            before[r, same_key(k)] = state
            own = carries.get((r, same_key(k)))
            state = own if state is None else combine(conf, k, state, own) if own is not None else state
    numbers = {(r, same_key(k)): (i, n) for r, k, i, n in pieces}
    shared = spark.sparkContext.broadcast((before, numbers))  # at most two carries a range

    def run(conf, k, batches):
        states, places = shared.value
        first = next(batches)
        at = first.column(RANGE)[0].as_py(), same_key(_plain(k))
        return fn(dict(conf, piece=places.get(at, (0, 1))), k,
                  (b.drop_columns([RANGE]) for b in itertools.chain([first], batches)), states.get(at))

    out_schema = T.StructType([T.StructField("key", key_type), T.StructField("index", T.LongType()), *schema.fields])
    out = ranged.mapInArrow(runner(run, schema, key_type, True), out_schema)
    if not pieces:
        return out
    # a split key's outputs are numbered on from piece to piece; its empty pieces leave no row
    out = out.withColumn(RANGE, F.spark_partition_id()).checkpoint(eager=True)
    at = F.broadcast(_piece_table(spark, [p[:2] for p in pieces], key_type).toDF(RANGE, "key"))
    sizes = {(r[RANGE], same_key(_plain(r["key"]))): r["n"] for r in out.join(at, [RANGE, "key"], "left_semi").groupBy(
        RANGE, "key").agg(F.count("index").alias("n")).collect()}
    moved, sofar, kept = [], 0, False
    totals: dict = {}
    for (r, k, i, n) in pieces:
        totals[same_key(k)] = totals.get(same_key(k), 0) + sizes.get((r, same_key(k)), 0)
    for r, k, i, _ in pieces:
        sofar, kept = (0, False) if i == 0 else (sofar, kept)
        here = (r, same_key(k)) in sizes
        moved.append((r, k, sofar, totals[same_key(k)] == 0 and here and not kept))
        kept = kept or here
        sofar += sizes.get((r, same_key(k)), 0)
    shift = _piece_table(spark, moved, key_type, T.StructField("_shift", T.LongType()),
                         T.StructField("_empty", T.BooleanType())).withColumnRenamed(PIECE_KEY, "key")
    out = out.join(F.broadcast(shift), [RANGE, "key"], "left").where(
        F.col("index").isNotNull() | F.col("_shift").isNull() | F.col("_empty"))
    return out.select("key", (F.col("index") + F.coalesce("_shift", F.lit(0))).alias("index"), *schema.names)


def hot_keys(keyed: DataFrame, key: str, n_ranges: int) -> list:
    """Keys with more than ``HOT_RANGES`` ranges' worth of rows: at most
    ``n_ranges / HOT_RANGES`` of them."""
    sizes = keyed.groupBy(key).agg(F.count("*").alias("n"))
    total = keyed.count()
    return [_plain(r[key]) for r in sizes.where(F.col("n") * n_ranges > F.lit(HOT_RANGES) * F.lit(total)).collect()]


def numbered_values(keyed: DataFrame, key: str, order_by=(), n_ranges: int | None = None) -> DataFrame:
    """``keyed`` with ``index``, the place of each row in its key in ``order_by`` order
    (from 0).  No Python, and no task holds a hot key."""
    spark = keyed.sparkSession
    n = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(keyed, key, n)
    w = Window.partitionBy(key).orderBy(*(order_by or [key]))
    number = (F.row_number().over(w) - 1).cast("long")
    if not hot:
        return keyed.withColumn("index", number)
    key_type = keyed.schema[key].dataType
    few = F.broadcast(spark.createDataFrame([(k,) for k in hot], T.StructType([T.StructField(key, key_type)])))
    ranged = even_ranges(keyed.join(few, key, "left_semi"), key, *order_by, n=n)
    # pieces of hot keys: as many as ranges and keys
    runs = ranged.groupBy(RANGE, key).agg(F.min(PLACE).alias("_first"), F.count("*").alias("_size"))
    before = Window.partitionBy(key).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(RANGE, key, "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    spread = ranged.join(F.broadcast(runs), [RANGE, key]).withColumn(
        "index", F.col(PLACE) - F.col("_first") + F.col("_before"))
    cold = keyed.join(few, key, "left_anti").withColumn("index", number)
    return cold.unionByName(spread.select(*cold.columns))
