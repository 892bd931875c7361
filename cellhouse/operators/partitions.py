"""Keyed partition map / for-each with user Python functions.

Keyed form: rows with a null key are dropped, the rest are hash-partitioned
by key and sorted by it inside each task, and a ``mapInArrow`` generator
cuts the sorted stream into runs of one key.  The user function gets an
*iterator* of Arrow record batches for its key, so a group is streamed,
never materialised in memory; a hot key costs time in one task, not memory.

When the function is decomposable, pass ``partial``: it runs on runs of each
key's rows inside every input partition *before* the shuffle (pre-aggregation),
and the keyed function then sees only those partial rows.

When it is not, but what it knows of the rows before can be folded, pass
``carry`` and ``combine``: rows are dealt over even ranges, and a hot key's run
is cut into pieces that run side by side (a parallel scan, see ``ranges``).

Unkeyed form (U3): every Spark partition is one group; no shuffle.
"""

from __future__ import annotations

import itertools
import uuid
from typing import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .ranges import numbered_values, scan_partitions

KEY = "_pkey"


def _slices(batches: Iterator[pa.RecordBatch], key: str):
    """``(key value, slice)`` for the runs of one key inside each batch."""
    for b in batches:
        if b.num_rows == 0:
            continue
        col = b.column(b.schema.get_field_index(key))
        cuts = [0]
        if b.num_rows > 1:
            differ = pc.fill_null(pc.not_equal(col.slice(1), col.slice(0, b.num_rows - 1)), True)
            cuts += [i + 1 for i in pc.indices_nonzero(differ).to_pylist()]
        for s, e in zip(cuts, cuts[1:] + [b.num_rows]):
            yield col[s].as_py(), b.slice(s, e - s)


def _batches_by_key(batches: Iterator[pa.RecordBatch], key: str):
    """``(key value, iterator of its batches)``, both lazy: a batch is pulled
    when the user function asks for it, and what the function leaves of a
    group is drained before the next group starts."""

    def same(piece):  # NaN is one key
        return piece[0] if piece[0] == piece[0] else "nan"

    for _, run in itertools.groupby(_slices(batches, key), same):
        k, first = next(run)
        yield k, itertools.chain([first], (b for _, b in run))


def _keyed(df: DataFrame, key) -> DataFrame:
    k = F.col(key) if isinstance(key, str) else key
    return df.withColumn(KEY, k).where(F.col(KEY).isNotNull())


def _folded(keyed: DataFrame, partial: Callable, conf: dict, schema: T.StructType | None) -> DataFrame:
    """Pre-aggregation: ``partial`` on the rows of each key in an Arrow batch of an
    input partition -- no shuffle and no sort of the partition (a batch is ordered by
    key on its own).  Keys that Arrow cannot order are sorted by Spark first."""
    if schema is None:
        raise ValueError("partial needs partial_schema")
    key_type = keyed.schema[KEY].dataType
    run = _group_runner(partial, conf, key_type, schema, with_index=False)
    out = T.StructType([T.StructField(KEY, key_type)] + list(schema.fields))
    if isinstance(key_type, (T.StructType, T.ArrayType, T.MapType)):
        return keyed.sortWithinPartitions(KEY).mapInArrow(run, out)

    def run_sorted(batches):
        return run(b.take(pc.sort_indices(b.column(b.schema.get_field_index(KEY)))) for b in batches)

    return keyed.mapInArrow(run_sorted, out)


def map_partitions(df: DataFrame, key, fn: Callable, schema: T.StructType, conf: dict | None = None,
                   partial: Callable | None = None, partial_schema: T.StructType | None = None,
                   order_by=(), carry: Callable | None = None, combine: Callable | None = None,
                   carry_schema: T.StructType | None = None, n_ranges: int | None = None) -> DataFrame:
    """``fn(conf, key, batches)`` returns ``None``, or an iterable of
    dicts / tuples / ``pa.RecordBatch`` (a generator is consumed lazily).

    Output rows are ``(key, index, *schema)``: ``index`` numbers a group's
    outputs; a group whose result is empty keeps one row with null
    ``index`` and fields; a ``None`` result drops the group.  ``key`` is a
    column name or Column; ``key=None`` means unkeyed (U3).  ``order_by``
    columns sort the rows inside each group, so order-dependent functions
    (running totals) can stream instead of collecting the group.

    Hot keys: with ``carry(conf, key, batches)`` (a tuple of ``carry_schema``: what
    the function must know of these rows to go on behind them) and the associative
    ``combine(conf, key, a, b)``, rows are cut into ``n_ranges`` even ranges whatever
    their keys, and the function is ``fn(conf, key, batches, state)``, called for each
    piece of a key with the combined carry of the pieces before it (None at the
    first); ``conf["piece"]`` is (its number, how many).
    """
    conf = dict(conf or {})
    ship_package(df.sparkSession)
    if key is None:
        return map_partitions_unkeyed(df, fn, schema, conf)
    keyed = _keyed(df, key)
    key_type = keyed.schema[KEY].dataType
    if carry is not None:
        if combine is None or carry_schema is None or partial is not None:
            raise ValueError("carry needs combine and carry_schema, and goes without partial")
        return scan_partitions(keyed, KEY, fn, schema, carry, combine, carry_schema,
                               lambda f, out, kind, index: _group_runner(f, conf, kind, out, index), conf, order_by,
                               n_ranges)
    if partial is not None:
        keyed = _folded(keyed, partial, conf, partial_schema)
    out_schema = T.StructType(
        [T.StructField("key", key_type), T.StructField("index", T.LongType())] + list(schema.fields)
    )
    moved = keyed.repartition(KEY).sortWithinPartitions(KEY, *order_by)
    return moved.mapInArrow(_group_runner(fn, conf, key_type, schema, with_index=True), out_schema)


CHUNK = 4096
#: batches below this many rows are gathered with others instead of framed alone
SMALL = 64


def _group_runner(fn, conf, key_type: T.DataType, schema: T.StructType, with_index: bool):
    """Run ``fn`` per key run and stream its output: neither a group's input
    nor its output is ever held whole.  Record batches pass through with the
    key (and index) columns added; single rows are gathered in chunks."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [f.name for f in schema.fields]
    head = [T.StructField("key" if with_index else KEY, key_type)]
    head += [T.StructField("index", T.LongType())] if with_index else []
    out_schema = to_arrow_schema(T.StructType(head + list(schema.fields)))
    key_name, key_arrow = out_schema[0].name, out_schema[0].type

    def gathered(buf_k, buf_i, buf_r):
        cols = {key_name: list(buf_k)}
        if with_index:
            cols["index"] = list(buf_i)
        cols.update({n: [None if r is None else r[i] for r in buf_r] for i, n in enumerate(names)})
        buf_k.clear(), buf_i.clear(), buf_r.clear()
        return pa.RecordBatch.from_pydict(cols, schema=out_schema)

    def framed(k, n, b):
        # a batch of the function, as it is, behind its key and index
        cols = [pa.array([k], key_arrow).take(pa.array([0] * b.num_rows, pa.int64()))]
        if with_index:
            cols.append(pa.array(range(n, n + b.num_rows), pa.int64()))
        for i, name in enumerate(names):
            cols.append(b.column(b.schema.get_field_index(name)).cast(out_schema[len(head) + i].type))
        return pa.RecordBatch.from_arrays(cols, schema=out_schema)

    def run(batches):
        # no closure state shared between nested functions: it does not
        # survive pickling to the workers
        buf_k, buf_i, buf_r = [], [], []
        for k, pieces in _batches_by_key(batches, KEY):
            res = fn(conf, k, (p.drop_columns([KEY]) for p in pieces))
            if res is None:
                continue
            if isinstance(res, (pa.RecordBatch, pa.Table)):
                res = [res]
            n = 0
            for item in res:
                if isinstance(item, (pa.RecordBatch, pa.Table)):
                    for b in item.to_batches() if isinstance(item, pa.Table) else [item]:
                        if b.num_rows and b.num_rows < SMALL:
                            d = b.to_pydict()
                            for r in zip(*[d[c] for c in names]):
                                buf_k.append(k), buf_i.append(n), buf_r.append(r)
                                n += 1
                        elif b.num_rows:
                            if buf_k:
                                yield gathered(buf_k, buf_i, buf_r)
                            yield framed(k, n, b)
                            n += b.num_rows
                else:
                    buf_k.append(k), buf_i.append(n)
                    buf_r.append(tuple(item.get(c) for c in names) if isinstance(item, dict) else tuple(item))
                    n += 1
                if len(buf_k) >= CHUNK:
                    yield gathered(buf_k, buf_i, buf_r)
            if n == 0 and with_index:
                buf_k.append(k), buf_i.append(None), buf_r.append(None)  # empty result: group kept
        if buf_k:
            yield gathered(buf_k, buf_i, buf_r)

    return run


def _rows_of(res, names):
    if isinstance(res, pa.RecordBatch) or isinstance(res, pa.Table):
        d = res.to_pydict()
        return list(zip(*[d[n] for n in names])) if res.num_rows else []
    out = []
    for r in res:
        if isinstance(r, dict):
            out.append(tuple(r.get(n) for n in names))
        else:
            out.append(tuple(r))
    return out


def map_partitions_unkeyed(df: DataFrame, fn: Callable, schema: T.StructType, conf: dict | None = None) -> DataFrame:
    """Each Spark partition is one group (``key`` = None); no shuffle."""
    conf = dict(conf or {})
    ship_package(df.sparkSession)
    names = [f.name for f in schema.fields]
    from pyspark.sql.pandas.types import to_arrow_schema

    sch = to_arrow_schema(schema)

    def run(batches):
        res = fn(conf, None, batches)
        if res is None:
            return
        if isinstance(res, (pa.RecordBatch, pa.Table)):
            for b in (res.to_batches() if isinstance(res, pa.Table) else [res]):
                yield b
            return
        rows = []
        for item in res:
            if isinstance(item, pa.RecordBatch):
                if rows:
                    yield framed(rows)
                    rows = []
                yield item
            else:
                rows += _rows_of([item], names)
                if len(rows) >= CHUNK:
                    yield framed(rows)
                    rows = []
        if rows:
            yield framed(rows)

    def framed(rows):
        return pa.RecordBatch.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(names)}, schema=sch)

    return df.mapInArrow(run, schema)


def foreach_partition(df: DataFrame, key, fn: Callable, conf: dict | None = None, partial: Callable | None = None,
                      partial_schema: T.StructType | None = None, order_by=(), carry: Callable | None = None,
                      combine: Callable | None = None, carry_schema: T.StructType | None = None,
                      n_ranges: int | None = None) -> None:
    """``fn(conf, key, batches)`` once per key for its side effect.

    Keyed: hash partition + in-task sort, one call per key run.  ``partial``
    folds each key's rows inside every input partition before the shuffle, as
    in ``map_partitions``; ``fn`` then sees the partial rows.  Unkeyed
    (``key=None``): one call per Spark partition, no shuffle.  With ``carry`` and
    ``combine`` (see ``map_partitions``) a hot key is split: ``fn(conf, key, batches,
    state)`` once per piece, told apart by ``conf["piece"]``.  Runs now.
    """
    conf = dict(conf or {})
    ship_package(df.sparkSession)
    if carry is not None:
        def done(conf, k, batches, state):
            fn(conf, k, batches, state)
            return [(1,)]

        one = T.StructType([T.StructField("n", T.LongType())])
        map_partitions(df, key, done, one, conf, order_by=order_by, carry=carry, combine=combine,
                       carry_schema=carry_schema, n_ranges=n_ranges).agg(F.sum("n")).collect()
        return
    if key is None:
        def run_all(batches):
            fn(conf, None, batches)
            return iter(())
        df.mapInArrow(run_all, "n long").count()
        return
    keyed = _keyed(df, key)
    if partial is not None:
        keyed = _folded(keyed, partial, conf, partial_schema)

    def run(batches):
        n = 0
        for k, pieces in _batches_by_key(batches, KEY):
            fn(conf, k, (p.drop_columns([KEY]) for p in pieces))
            n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    keyed.repartition(KEY).sortWithinPartitions(KEY).mapInArrow(run, "n long").agg(F.sum("n")).collect()


def bundles(batches: Iterator[pa.RecordBatch], max_rows: int, max_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    """Runs of batches of at most ``max_rows`` rows and ``max_bytes`` bytes (one row at
    least), in order; batches are sliced, not copied."""
    held, rows, size = [], 0, 0
    for b in batches:
        while b.num_rows:
            each = max(1, -(-b.nbytes // b.num_rows))
            take = min(b.num_rows, max_rows - rows, max((max_bytes - size) // each, 0 if held else 1))
            while take > 1 and b.slice(0, take).nbytes > max_bytes - size:  # rows are not all alike
                take //= 2
            if take == 1 and held and b.slice(0, 1).nbytes > max_bytes - size:
                take = 0
            if take:
                held.append(b.slice(0, take))
                rows, size, b = rows + take, size + held[-1].nbytes, b.slice(take)
            if b.num_rows or rows == max_rows:
                yield held
                held, rows, size = [], 0, 0
    if held:
        yield held


def map_bundles(df: DataFrame, fn: Callable, schema: T.StructType, conf: dict | None = None, max_rows: int = 1000,
                max_bytes: int = 1 << 20) -> DataFrame:
    """U3 by bundles: ``fn(conf, bundle, batches)`` for runs of at most ``max_rows`` rows
    and ``max_bytes`` bytes of a partition; ``bundle`` is ``(partition, number)``, the
    same when a task runs again.  No shuffle; output rows as in ``map_partitions``,
    with ``bundle`` ("partition-number") before them."""
    conf = dict(conf or {})
    ship_package(df.sparkSession)
    names = schema.names
    from pyspark.sql.pandas.types import to_arrow_schema

    out_schema = T.StructType([T.StructField("bundle", T.StringType()), *schema.fields])
    arrow = to_arrow_schema(out_schema)

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for n, held in enumerate(bundles(batches, max_rows, max_bytes)):
            res = fn(conf, (part, n), iter(held))
            rows = [] if res is None else [r for item in ([res] if isinstance(res, (pa.RecordBatch, pa.Table)) else res)
                                           for r in _rows_of(item if isinstance(item, (pa.RecordBatch, pa.Table)) else [item],
                                                             names)]
            if rows:
                yield pa.RecordBatch.from_pydict({"bundle": [f"{part}-{n}"] * len(rows), **{
                    c: [r[i] for r in rows] for i, c in enumerate(names)}}, schema=arrow)

    return df.mapInArrow(run, out_schema)


def foreach_committed(df: DataFrame, key, fn: Callable, commit: Callable, abort: Callable | None = None,
                      conf: dict | None = None, partial: Callable | None = None,
                      partial_schema: T.StructType | None = None) -> None:
    """U1 with side effects that count once: ``fn(conf, key, batches)`` per key, where
    ``conf["attempt"]`` names the running task attempt and the effect is kept under that
    name; when all tasks are done, ``commit(conf, attempts)`` runs once, in a Python
    process beside the driver (there is no session), with the one attempt of each task
    that counts (``abort`` with those known if the job fails).  What attempts that failed or ran twice left behind is not among them."""
    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

    spark, conf = df.sparkSession, dict(conf or {})
    ship_package(spark)
    keyed = _keyed(df, key)
    if partial is not None:
        keyed = _folded(keyed, partial, conf, partial_schema)
    name = f"effects_{uuid.uuid4().hex}"

    class Attempt(WriterCommitMessage):
        def __init__(self, name: str):
            self.name = name

    class Writer(DataSourceArrowWriter):
        def write(self, iterator):
            from pyspark import TaskContext

            t = TaskContext.get()
            mine = dict(conf, attempt=f"{t.partitionId()}-{t.taskAttemptId()}")
            for k, pieces in _batches_by_key(iterator, KEY):
                fn(mine, k, (p.drop_columns([KEY]) for p in pieces))
            return Attempt(mine["attempt"])

        def commit(self, messages):
            commit(conf, sorted(m.name for m in messages if m is not None))

        def abort(self, messages):
            if abort is not None:
                abort(conf, sorted(m.name for m in messages if m is not None))

    class Effects(DataSource):
        @classmethod
        def name(cls):
            return name

        def writer(self, schema, overwrite):
            return Writer()

    spark.dataSource.register(Effects)
    keyed.repartition(KEY).sortWithinPartitions(KEY).write.format(name).mode("append").save()


def group_values(df: DataFrame, key, values: T.StructType, order_by=(), n_ranges: int | None = None) -> DataFrame:
    """A1: the values of each key, ``(key, index, *values)``: ``values`` names
    columns of ``df``; ``index`` numbers them in ``order_by`` order.  No Python
    and no list of a group; a hot key's rows spread over ``n_ranges`` tasks."""
    names = [f.name for f in values.fields]
    keyed = _keyed(df, key).select(KEY, *dict.fromkeys([*names, *(c for c in order_by if isinstance(c, str))]))
    out = numbered_values(keyed, KEY, order_by, n_ranges)
    return out.select(F.col(KEY).alias("key"), "index", *(F.col(f.name).cast(f.dataType).alias(f.name) for f in values))


def arrow_rows(batches: Iterable[pa.RecordBatch]):
    """Helper for user functions: iterate rows of the batches as dicts."""
    for b in batches:
        yield from b.to_pylist()
