"""Hot keys: parallel scans, numbering and side effects with one key in many tasks."""

import random
import sys

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellhouse.operators.partitions import arrow_rows, foreach_partition, group_values, map_partitions
from cellhouse.operators.ranges import RANGE, even_ranges, split_pieces

from conftest import SF_SMALL

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests

OUT = T.StructType([T.StructField("v", T.LongType()), T.StructField("sofar", T.LongType())])
STATE = T.StructType([T.StructField("sum", T.LongType()), T.StructField("n", T.LongType())])


def fold(conf, key, batches):
    s = n = 0
    for b in batches:
        s, n = s + (pc.sum(b.column("v")).as_py() or 0), n + b.num_rows
    return s, n


def add(conf, key, a, b):
    return a[0] + b[0], a[1] + b[1]


def running(conf, key, batches, state):
    s = state[0] if state else 0
    for r in arrow_rows(batches):
        s += r["v"]
        yield {"v": r["v"], "sofar": s}


def expected(rows):
    by = {}
    for k, v in sorted((r for r in rows if r[0] is not None), key=lambda r: r[1]):
        by.setdefault(k, []).append(v)
    out = []
    for k, vs in by.items():
        s = 0
        for i, v in enumerate(vs):
            s += v
            out.append((k, i, v, s))
    return sorted(out)


@pytest.fixture(scope="module")
def skewed():
    r = random.Random(4)
    return [(0 if i % 3 else r.randrange(1, 50), i) for i in range(3000)] + [(None, 5), (77, -3)]


def test_scan_of_hot_key_equals_one_pass(spark, skewed):
    df = spark.createDataFrame(skewed, "k long, v long").repartition(5)
    for n in (1, 2, 7, 40):
        got = map_partitions(df, "k", running, OUT, order_by=("v",), carry=fold, combine=add, carry_schema=STATE, n_ranges=n)
        assert sorted(tuple(r) for r in got.collect()) == expected(skewed)


def test_no_range_holds_a_hot_key_whole(spark):
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn(
        "k", F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_orderkey")))
    ranged = even_ranges(lines.select("k", "l_orderkey"), "k", "l_orderkey", n=16)
    sizes = sorted(r["count"] for r in ranged.groupBy(RANGE).count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]
    pieces = split_pieces(ranged, "k")
    assert max(of for *_, of in pieces) >= 5
    # even without any order, and with equal rows only
    same = even_ranges(spark.range(4000).select(F.lit(1).alias("k")), "k", n=8)
    sizes = sorted(r["count"] for r in same.groupBy(RANGE).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]


def test_pieces_with_empty_and_missing_results(spark, skewed):
    df = spark.createDataFrame(skewed, "k long, v long").repartition(3)

    def even_only(conf, key, batches, state):
        if key == 7:
            return None  # the group goes
        seen = state[1] if state else 0
        out = []
        for r in arrow_rows(batches):
            if key == 0 and seen < 1000:  # nothing from the first pieces
                seen += 1
                continue
            if key != 0:
                continue  # an empty result keeps the group
            out.append((r["v"], 0))
        return out

    got = map_partitions(df, "k", even_only, OUT, order_by=("v",), carry=fold, combine=add, carry_schema=STATE, n_ranges=20)
    rows = sorted(tuple(r) for r in got.collect() if r.key == 0)
    vs = sorted(v for k, v in skewed if k == 0)[1000:]
    assert rows == [(0, i, v, 0) for i, v in enumerate(vs)]
    others = [tuple(r) for r in got.collect() if r.key != 0]
    assert sorted(others) == sorted((k, None, None, None) for k in {k for k, _ in skewed} - {0, 7, None})

    def nothing(conf, key, batches, state):
        return []

    empty = map_partitions(df, "k", nothing, OUT, carry=fold, combine=add, carry_schema=STATE, n_ranges=20)
    assert sorted(r.key for r in empty.collect()) == sorted({k for k, _ in skewed} - {None})


@pytest.mark.parametrize("kind, keys", [("binary", [b"", b"a", b"b\xff"]), ("double", [float("nan"), 0.5, -1.0]),
                                        ("string", ["", "é", "z"])])
def test_scan_with_keys_of_other_types(spark, kind, keys):
    rows = [(bytearray(k) if isinstance(k, bytes) else k, i) for i in range(600) for k in [keys[0 if i % 4 else i % 3]]]
    df = spark.createDataFrame(rows, f"k {kind}, v long").repartition(4)
    got = map_partitions(df, "k", running, OUT, order_by=("v",), carry=fold, combine=add, carry_schema=STATE, n_ranges=12)

    def name(k):
        return bytes(k) if isinstance(k, (bytes, bytearray)) else "nan" if k != k else k

    assert sorted((str(name(r.key)), r["index"], r.v, r.sofar) for r in got.collect()) == sorted(
        expected([(str(name(k)), v) for k, v in rows]))


def test_carry_needs_its_parts(spark, skewed):
    df = spark.createDataFrame(skewed, "k long, v long")
    with pytest.raises(ValueError):
        map_partitions(df, "k", running, OUT, carry=fold)


def test_side_effects_per_piece(spark, skewed, tmp_path):
    df = spark.createDataFrame(skewed, "k long, v long").repartition(4)
    out = str(tmp_path)

    def write(conf, key, batches, state):
        number, of = conf["piece"]
        total, n = fold(conf, key, batches)
        with open(f"{conf['out']}/{key}-{number}-{of}", "w") as f:
            f.write(f"{state[0] if state else 0} {total} {n}")

    foreach_partition(df, "k", write, {"out": out}, order_by=("v",), carry=fold, combine=add, carry_schema=STATE, n_ranges=10)
    files = {}
    for p in tmp_path.iterdir():
        k, number, of = map(int, p.name.split("-"))
        files.setdefault(k, {})[number] = (of, *map(int, p.read_text().split()))
    assert set(files) == {k for k, _ in skewed} - {None}
    assert len(files[0]) > 3
    for k, pieces in files.items():
        sofar = 0
        for number in range(len(pieces)):
            of, before, total, n = pieces[number]
            assert of == len(pieces) and before == sofar
            sofar += total
        assert sofar == sum(v for kk, v in skewed if kk == k)


def test_values_of_hot_keys_are_numbered(spark, skewed):
    df = spark.createDataFrame(skewed, "k long, v long").repartition(4)
    values = T.StructType([T.StructField("v", T.LongType())])
    for n in (2, 16):
        out = group_values(df, "k", values, order_by=("v",), n_ranges=n)
        assert sorted(tuple(r) for r in out.collect()) == [r[:3] for r in expected(skewed)]
        assert "Python" not in out._jdf.queryExecution().toString()


def test_result_batches_may_be_arrow(spark, skewed):
    df = spark.createDataFrame(skewed, "k long, v long")

    def arrow(conf, key, batches, state):
        s = state[0] if state else 0
        for b in batches:
            run = pc.add(pc.cumulative_sum(b.column("v")), s)
            s = run[-1].as_py()
            yield pa.RecordBatch.from_arrays([b.column("v"), run], names=["v", "sofar"])

    got = map_partitions(df, "k", arrow, OUT, order_by=("v",), carry=fold, combine=add, carry_schema=STATE, n_ranges=9)
    assert sorted(tuple(r) for r in got.collect()) == expected(skewed)


def test_effects_of_failed_attempts_do_not_count(spark, tmp_path):
    """A task that fails once leaves one result per key among the attempts that count."""
    import json
    import subprocess
    import sys as system

    from conftest import ROOT

    script = tmp_path / "job.py"
    script.write_text(f"""
import json, os, sys
sys.path.insert(0, {ROOT!r})
from cellhouse.session import build_session
from cellhouse.operators.partitions import foreach_committed
spark = build_session("local[2, 3]", shuffle_partitions=4)
spark.sparkContext.setLogLevel("OFF")
out = {str(tmp_path)!r}

def effect(conf, key, batches):
    os.makedirs(f"{{out}}/{{conf['attempt']}}", exist_ok=True)
    with open(f"{{out}}/{{conf['attempt']}}/{{key}}", "w") as f:
        f.write(str(sum(b.num_rows for b in batches)))
    if key == 7 and not os.path.exists(f"{{out}}/failed"):
        open(f"{{out}}/failed", "w").close()
        raise RuntimeError("once")

def commit(conf, attempts):
    with open(f"{{out}}/commits", "a") as f:
        f.write(json.dumps(attempts) + "\\n")

df = spark.range(1000).selectExpr("id % 20 as k", "id as v")
foreach_committed(df, "k", effect, commit)
""")
    subprocess.run([system.executable, str(script)], check=True, timeout=300)
    commits = (tmp_path / "commits").read_text().split("\n")[:-1]
    assert len(commits) == 1 and (tmp_path / "failed").exists()
    kept = [p for a in json.loads(commits[0]) for p in (tmp_path / a).iterdir()]
    assert sorted(int(p.name) for p in kept) == list(range(20)) and all(p.read_text() == "50" for p in kept)
    left = [p for p in tmp_path.glob("*-*/*") if p.name == "7"]
    assert len(left) == 2  # one of an attempt that does not count


def test_bundles_are_bounded_and_stable(spark):
    from cellhouse.operators.partitions import bundles, map_bundles

    r = random.Random(1)
    rows = [(i, "x" * r.choice([1, 5, 3000])) for i in range(2000)]
    df = spark.createDataFrame(rows, "i long, t string").repartition(3)
    out = T.StructType([T.StructField("n", T.LongType()), T.StructField("size", T.LongType()), T.StructField("first", T.LongType())])

    def sizes(conf, bundle, batches):
        held = list(batches)
        return [(sum(b.num_rows for b in held), sum(b.nbytes for b in held), held[0].column(0)[0].as_py())]

    one, two = (sorted(map(tuple, map_bundles(df, sizes, out, max_rows=40, max_bytes=6000).collect())) for _ in range(2))
    assert one == two and sum(x[1] for x in one) == 2000 and len({x[0] for x in one}) == len(one)
    assert max(x[1] for x in one) <= 40 and all(x[2] <= 6000 or x[1] == 1 for x in one)
    big = pa.RecordBatch.from_pydict({"t": ["y" * 10000] * 3})
    assert [sum(b.num_rows for b in held) for held in bundles(iter([big]), 10, 100)] == [1, 1, 1]


def test_splits_from_a_sketch_are_even(spark):
    from cellhouse.functions.regions import region_index
    from cellhouse.operators.splits import Sketch, data_splits

    r = random.Random(3)
    keys = [bytearray(b"common/prefix/" + str(r.randrange(10 ** 6)).encode()) if r.random() < 0.8 else bytearray([r.randrange(256), i % 256])
            for i in range(30000)] + [None, None]
    df = spark.createDataFrame([(k,) for k in keys], "k binary").repartition(7)
    splits = data_splits(df, "k", 16)
    sizes = [x["count"] for x in df.where("k is not null").groupBy(region_index("k", [b"", *splits])).count().collect()]
    assert len(splits) == 15 and max(sizes) <= 1.2 * 30000 / 16
    a, b = Sketch(size=64), Sketch(size=64, seed=1)
    a.add([b"%06d" % i for i in range(5000)])
    b.add([b"%06d" % i for i in range(5000, 10000)])
    for level, ks in enumerate(b.levels):
        a.add(ks, level)
    assert abs(int(a.quantiles(2)[0]) - 5000) < 800 and sum(len(x) for x in a.levels) < 2 * 64 * len(a.levels)
    assert data_splits(df.where("false"), "k", 4) == []
    assert data_splits(spark.createDataFrame([("same",)] * 50, "k string"), "k", 4) == [b"same"]


def test_hash_filter_keeps_all_requested_rows_and_few_others(spark):
    from cellhouse.operators.lookup import key_filter, maybe_requested

    cells = spark.range(20000).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("row"), "id")
    keys = cells.where("id % 10 = 3").select("row")
    for bits, most in ((64 << 20, 2000 * 0.08 + 2000 + 1400), (2000, 20000)):
        got = {x.id for x in maybe_requested(cells, keys, 2000, bits).collect()}
        assert {i for i in range(20000) if i % 10 == 3} <= got and len(got) <= most
    assert key_filter(keys, 1 << 40, 1 << 20) is None
