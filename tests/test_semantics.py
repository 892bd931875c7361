"""Visibility, duplicate, null, lookup and load edge cases (FIXTURES C)."""

import pytest
from pyspark.sql import functions as F

from cellhouse import DELETE_COLUMN, DELETE_FAMILY, DELETE_VERSION, PUT, new_path, read_table
from cellhouse.operators.load import bulk_load, bulk_load_thin_rows, publish_staged, stage
from cellhouse.operators.lookup import bulk_get, bulk_get_cells, bulk_get_exists, bulk_get_missing, bulk_get_rows
from cellhouse.operators.mutate import apply_mutations, bulk_delete, bulk_put
from cellhouse.operators.partitions import _batches_by_key, foreach_partition, group_values, map_partitions
from cellhouse.operators.visibility import collapse_identical, visible_cells

SCHEMA = "row string, family string, qualifier string, ts long, value string"


def put(spark, t, rows, seq=None):
    df = spark.createDataFrame(rows, SCHEMA)
    if seq is not None:
        df = df.withColumn("seq", F.lit(seq).cast("long"))
    bulk_put(t, df)


def view(t, **kw):
    return sorted((bytes(r.row).decode(), r.family, bytes(r.qualifier).decode(), r.ts, bytes(r.value).decode())
                  for r in read_table(t, **kw).collect())


def test_tombstone_before_at_after(spark, tmp_table):
    t = tmp_table(["f"])
    put(spark, t, [("r", "f", "q", 10, "a"), ("r", "f", "q", 20, "b"), ("r", "f", "q", 30, "c")])
    bulk_delete(t, spark.createDataFrame([("r", "f", "q")], "row string, family string, qualifier string")
                .select(F.encode("row", "UTF-8").alias("row"), "family", F.encode("qualifier", "UTF-8").alias("qualifier")),
                scope="column", ts=20)
    # puts at and before the tombstone are hidden, the later one shows
    assert view(t, versions=None) == [("r", "f", "q", 30, "c")]
    # a later put below the tombstone stays hidden; above it shows
    put(spark, t, [("r", "f", "q", 15, "late"), ("r", "f", "q", 25, "new")])
    assert view(t, versions=None) == [("r", "f", "q", 25, "new"), ("r", "f", "q", 30, "c")]


def test_each_delete_scope(spark, tmp_table):
    t = tmp_table(["f", "g"])
    rows = [("r1", "f", "q1", 5, "a"), ("r1", "f", "q2", 5, "b"), ("r1", "g", "q1", 5, "c"),
            ("r2", "f", "q1", 5, "d"), ("r2", "f", "q1", 6, "e"), ("r3", "g", "q1", 5, "h")]
    put(spark, t, rows)
    b = lambda c: F.encode(F.col(c), "UTF-8")
    bulk_delete(t, spark.createDataFrame([("r1",)], "row string").select(b("row").alias("row")), "row", ts=5)
    bulk_delete(t, spark.createDataFrame([("r3", "g")], "row string, family string")
                .select(b("row").alias("row"), "family"), "family", ts=9)
    bulk_delete(t, spark.createDataFrame([("r2", "f", "q1", 6)], "row string, family string, qualifier string, ts long")
                .select(b("row").alias("row"), "family", b("qualifier").alias("qualifier"), "ts"), "version")
    assert view(t) == [("r2", "f", "q1", 5, "d")]


def test_mixed_mutations_and_bad_op(spark, tmp_table):
    t = tmp_table(["f", "g"])
    m = spark.createDataFrame(
        [("r1", "f", "q", 1, "a", PUT), ("r1", "g", "q", 1, "b", PUT), ("r2", "f", "q", 1, "c", PUT),
         ("r1", None, None, 2, None, DELETE_FAMILY), ("r2", "f", "q", 1, None, DELETE_VERSION)],
        "row string, family string, qualifier string, ts long, value string, op int")
    apply_mutations(t, m)
    assert view(t) == []
    bad = spark.createDataFrame([("r", "f", "q", 1, "x", 99)], m.schema)
    with pytest.raises(Exception):
        apply_mutations(t, bad)
    assert view(t) == []  # the failed load was never published


def test_duplicate_cells_latest_arrival_wins(spark, tmp_table):
    t = tmp_table(["f"])
    df = spark.createDataFrame([("r", "f", "q", 1, "first", 1), ("r", "f", "q", 1, "second", 2)],
                               SCHEMA + ", seq long")
    bulk_put(t, df)
    assert view(t) == [("r", "f", "q", 1, "second")]
    put(spark, t, [("r", "f", "q", 1, "third")], seq=0)  # a later load beats any seq of an earlier one
    assert view(t, versions=None) == [("r", "f", "q", 1, "third")]


def test_versions_count_distinct_timestamps(spark, tmp_table):
    t = tmp_table(["f"])
    put(spark, t, [("r", "f", "q", ts, f"v{ts}") for ts in (1, 2, 3, 4)])
    put(spark, t, [("r", "f", "q", 4, "v4b")])
    assert [x[4] for x in view(t, versions=2)] == ["v3", "v4b"]
    assert len(view(t, versions=None)) == 4


def test_collapse_identical(spark):
    df = spark.createDataFrame([(b"r", "f", b"q", 1, PUT, b"a", 1), (b"r", "f", b"q", 1, PUT, b"b", 5),
                                (b"r", "f", b"q", 2, PUT, b"c", 0)],
                               "row binary, family string, qualifier binary, ts long, op int, value binary, seq long")
    got = sorted((r.ts, bytes(r.value)) for r in collapse_identical(df).collect())
    assert got == [(1, b"b"), (2, b"c")]


def test_null_keys_and_cells_dropped(spark, tmp_table):
    t = tmp_table(["f"])
    put(spark, t, [(None, "f", "q", 1, "x"), ("r", "f", None, 1, "y"), ("r", "f", "q", 1, "z")])
    assert view(t) == [("r", "f", "q", 1, "z")]
    # thin rows: null array and null element skipped
    t2 = tmp_table(["f"])
    df = spark.createDataFrame([("a", [("f", "q", "1"), None]), ("b", None), (None, [("f", "q", "2")])],
                               "row string, cells array<struct<family:string,qualifier:string,value:string>>")
    bulk_load_thin_rows(t2, df, F.col("row"), F.col("cells"), ts=1)
    assert view(t2) == [("a", "f", "q", 1, "1")]


def test_unknown_family_fails_before_publish(spark, tmp_table):
    t = tmp_table(["f"])
    with pytest.raises(Exception):
        put(spark, t, [("r", "nope", "q", 1, "x")])
    assert t.committed_loads() == []


def test_existing_staging_path(spark, tmp_table):
    t = tmp_table(["f"])
    p = new_path(spark, "stage")
    spark.range(1).write.parquet(p)
    df = spark.createDataFrame([("r", "f", "q", 1, "x")], SCHEMA)
    with pytest.raises(FileExistsError):
        bulk_load(t, df, staging=p)


def test_empty_load(spark, tmp_table):
    t = tmp_table(["f"])
    r = bulk_load(t, spark.createDataFrame([], SCHEMA))
    assert r.load_id in t.committed_loads()
    assert read_table(t).count() == 0


def test_staged_is_invisible_until_published(spark, tmp_table):
    t = tmp_table(["f"])
    s = stage(t, spark.createDataFrame([("r", "f", "q", 1, "x")], SCHEMA), new_path(spark, "stage"))
    assert read_table(t).count() == 0
    publish_staged(t, s)
    assert view(t) == [("r", "f", "q", 1, "x")]


def test_lookup_edges(spark, tmp_table):
    t = tmp_table(["f"])
    put(spark, t, [("a", "f", "q", 1, "x"), ("b", "f", "q", 1, "y")])
    req = spark.createDataFrame([("a",), ("a",), ("zz",), (None,)], "row string")
    g = bulk_get(req, t, [("f", "q", "v")]).collect()
    assert sorted((r.row, r.found, None if r.v is None else bytes(r.v)) for r in g if r.row) == [
        ("a", True, b"x"), ("a", True, b"x"), ("zz", False, None)]
    assert len(g) == 3  # one result per request with a key; a null key asks for nothing
    assert sorted(r.row for r in bulk_get_exists(req, t).collect()) == ["a", "a"]
    assert [r.row for r in bulk_get_missing(req, t).collect()] == ["zz"]
    rows = sorted((r.row, [(c.family, bytes(c.qualifier), c.ts, bytes(c.value)) for c in r.cells])
                  for r in bulk_get_rows(req, t).collect())
    assert rows == [("a", [("f", b"q", 1, b"x")])] * 2 + [("zz", [])]
    empty = spark.createDataFrame([], "row string")
    assert bulk_get_cells(empty, t).count() == 0


def test_lookup_reads_exactly_the_named_columns(spark, tmp_table):
    t = tmp_table(["f1", "f2"])
    put(spark, t, [("r", "f1", "q2", 1, "decoy"), ("s", "f1", "q1", 1, "x"), ("s", "f2", "q1", 1, "decoy")])
    req = spark.createDataFrame([("r",), ("s",)], "row string")
    g = {r.row: (r.found, r.a and bytes(r.a), r.b) for r in bulk_get(req, t, [("f1", "q1", "a"), ("f2", "q2", "b")]).collect()}
    assert g == {"r": (False, None, None), "s": (True, b"x", None)}


def test_lookup_prunes_regions(spark, tmp_table):
    t = tmp_table(["f"], splits=["h", "p"])
    put(spark, t, [(k, "f", "q", 1, k) for k in "abcijkxyz"])
    req = spark.createDataFrame([("i",), ("k",)], "row string")
    plan = bulk_get(req, t, [("f", "q", "v")])._jdf.queryExecution().executedPlan().toString()
    scan = [x for x in plan.split("\n") if "PartitionFilters" in x]
    assert scan and all("region" in x.split("PartitionFilters")[1].split("PushedFilters")[0] for x in scan if "family" in x)


def test_reads_start_no_job(spark, tmp_table):
    t = tmp_table(["f"])
    put(spark, t, [("r", "f", "q", 1, "x"), ("s", "f", "q", 1, "y")])
    bulk_delete(t, spark.createDataFrame([(bytearray(b"r"),)], "row binary"), "row", ts=5)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("reads", "reads")
    out = read_table(t)
    assert list(tracker.getJobIdsForGroup("reads")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [bytes(r.row) for r in out.collect()] == [b"s"]
    # tombstones are looked for only in the load that holds some
    assert t.tombstones()[0] == [t.committed_loads()[1]] and t.tombstones()[1] == {DELETE_FAMILY}


def test_long_keys_stay_apart(spark):
    from cellhouse.functions.bytes import padded_key

    keys = [123456780, 123456789, 5, 9223372036854775807]
    got = [bytes(r[0]).decode() for r in spark.createDataFrame([(k,) for k in keys], "k long").select(padded_key("k")).collect()]
    assert [int(g) for g in got] == keys and {len(g) for g in got} == {19}


def test_null_time_takes_the_given_time(spark, tmp_table):
    t = tmp_table(["f"])
    bulk_load(t, spark.createDataFrame([("r", "f", "q", None, "x")], SCHEMA), ts=7)
    assert view(t) == [("r", "f", "q", 7, "x")]


def test_thin_rows_last_of_many_cells_wins(spark, tmp_table):
    t = tmp_table(["f"])
    df = spark.range(1).select(F.lit("r").alias("row"), F.transform(F.sequence(F.lit(0), F.lit(2999)), lambda i: F.struct(
        F.lit("f").alias("family"), F.lit("q").alias("qualifier"), F.lpad(i.cast("string"), 5, "0").alias("value"))).alias("cells"))
    bulk_load_thin_rows(t, df, F.col("row"), F.col("cells"), ts=1)
    assert view(t) == [("r", "f", "q", 1, "02999")]
    assert t.stored().select("seq", "pos").distinct().count() == 3000


def test_collapse_on_load(spark, tmp_table):
    t = tmp_table(["f"])
    df = spark.createDataFrame([("r", "f", "q", 1, f"v{i}", i % 7, i) for i in range(50)], SCHEMA + ", a int, seq long")
    bulk_load(t, df, collapse=["a"])
    assert t.stored().count() == 1 and view(t) == [("r", "f", "q", 1, "v48")]  # 48 % 7 = 6, the latest of those
    t2 = tmp_table(["f"])
    bulk_load(t2, df, collapse=True)
    assert t2.stored().count() == 1 and view(t2) == [("r", "f", "q", 1, "v49")]


def test_groups_are_pulled_lazily():
    import pyarrow as pa

    pulled = []

    def source():
        for i in range(5):
            pulled.append(i)
            yield pa.RecordBatch.from_pydict({"_pkey": ["k"] * 3 + (["l"] if i == 4 else []), "v": list(range(3 + (i == 4)))})

    groups = _batches_by_key(source(), "_pkey")
    key, batches = next(groups)
    assert key == "k" and next(batches).num_rows == 3 and pulled == [0]
    # what is left of a group is drained before the next one
    key, batches = next(groups)
    assert key == "l" and [b.num_rows for b in batches] == [1] and pulled == [0, 1, 2, 3, 4]
    assert list(groups) == []


@pytest.mark.parametrize("key", ["cast(id % 3 as int)", "date_add(date'2024-01-01', cast(id % 3 as int))",
                                 "cast(id % 3 as decimal(9,2))", "cast(id % 3 as tinyint)", "cast(id % 3 as double)",
                                 "timestamp_micros(id % 3)", "id % 2 = 0", "encode(cast(id % 3 as string), 'UTF-8')"])
def test_keys_of_every_type(spark, key):
    df = spark.range(200).select(F.expr(key).alias("k"), "id")
    schema = spark.createDataFrame([], "id long").schema
    got = group_values(df, "k", schema, order_by=("id",))
    assert got.schema["key"].dataType == df.schema["k"].dataType
    want = df.groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("s"), F.lit(True).alias("numbered"))
    have = got.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("n"), F.sum("id").alias("s"), (
        F.max("index") + 1 == F.count("*")).alias("numbered"))
    assert sorted(map(str, have.collect())) == sorted(map(str, want.collect()))


def test_foreach_partition_with_partial(spark):
    from cellhouse.session import local_path

    out = local_path(new_path(spark, "each"))
    schema = spark.createDataFrame([], "n long").schema

    def fold(conf, key, batches):
        return [(sum(b.num_rows if b.schema.names == ["id"] else sum(b.column("n").to_pylist()) for b in batches),)]

    def write(conf, key, batches):
        import os

        os.makedirs(conf["out"], exist_ok=True)
        with open(f"{conf['out']}/{key}", "w") as f:
            f.write(str(fold(conf, key, batches)[0][0]))

    foreach_partition(spark.range(1000).withColumn("k", F.col("id") % 4).drop("x").select("k", "id"), "k", _drop_key(write),
                      conf={"out": out}, partial=_drop_key(fold), partial_schema=schema)
    import os

    assert {int(k): int(open(f"{out}/{k}").read()) for k in os.listdir(out)} == {k: 250 for k in range(4)}


def _drop_key(fn):
    def run(conf, key, batches):
        return fn(conf, key, (b.drop_columns(["k"]) if "k" in b.schema.names else b for b in batches))
    return run


def test_many_regions_are_searched_without_python(spark):
    import bisect

    from cellhouse.functions.regions import region_index

    starts = sorted(f"{i * 7:06d}".encode() for i in range(1, 5001))
    rows = spark.range(0, 36000, 5).select(F.encode(F.format_string("%06d", "id"), "UTF-8").alias("row")).union(
        spark.createDataFrame([(None,), (bytearray(b""),), (bytearray(b"z"),)], "row binary"))
    out = rows.withColumn("r", region_index("row", starts))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        assert r.r == (None if r.row is None else bisect.bisect_right(starts, bytes(r.row)) - 1)


def test_map_partitions_null_and_empty_results(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5)], "k string, v long")
    schema = spark.createDataFrame([], "total long").schema

    def fn(conf, key, batches):
        total = sum(sum(b.column("v").to_pylist()) for b in batches)
        if key == "b":
            return None      # dropped
        if key == "c":
            return []        # kept as (key, null)
        return [(total,)]

    got = sorted((r["key"], r["index"], r["total"]) for r in map_partitions(df, "k", fn, schema).collect())
    assert got == [("a", 0, 3), ("c", None, None)]


def test_visible_cells_on_plain_dataframe(spark):
    df = spark.createDataFrame(
        [(b"r", "f", b"q", 1, PUT, b"a", 0), (b"r", "f", b"q", 2, PUT, b"b", 1),
         (b"r", "f", b"", 1, DELETE_FAMILY, None, 2), (b"s", "f", b"q", 3, PUT, b"c", 3),
         (b"s", "f", b"q", 3, DELETE_COLUMN, None, 4)],
        "row binary, family string, qualifier binary, ts long, op int, value binary, seq long")
    got = sorted((bytes(r.row), r.ts) for r in visible_cells(df).collect())
    assert got == [(b"r", 2)]


def test_scan_range_and_columns(spark, tmp_table):
    t = tmp_table(["f", "g"])
    put(spark, t, [(k, f, q, 1, k + f + q) for k in ("a", "aaa", "aab", "bbb", "c") for f in ("f", "g")
                   for q in ("q1", "q2")])
    rng = {x[0] for x in view(t, start_row="aaa", stop_row="bbb")}
    assert rng == {"aaa", "aab"}
    cols = view(t, families=["g"], qualifiers=["q2"])
    assert {(x[1], x[2]) for x in cols} == {("g", "q2")} and len(cols) == 5
    with pytest.raises(ValueError):
        view(t, families=["nope"])



def test_put_rejects_deletes(spark, tmp_table):
    # a put sink must not carry tombstones (and a delete sink builds only tombstones)
    t = tmp_table(["f"])
    df = spark.createDataFrame([("r", "f", "q", 1, "x", DELETE_COLUMN)], SCHEMA + ", op int")
    with pytest.raises(Exception):
        bulk_put(t, df)
    assert t.committed_loads() == []


def test_thin_rows_files_per_region_not_per_row(spark, tmp_table):
    from cellhouse import fs

    t = tmp_table(["f"], splits=["m"])
    df = spark.range(400).select(F.format_string("r%03d", "id").alias("k"), F.col("id"))
    cells = F.array(F.struct(F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
                             F.col("id").cast("string").alias("value")))
    r = bulk_load_thin_rows(t, df, F.col("k"), cells, ts=1)
    # 400 distinct rows, but files are per (family, region) and task, never per row
    assert fs.count_files(spark, r.path) < 40
    assert read_table(t).count() == 400


def test_ship_package_once_per_application(spark):
    import glob

    from cellhouse.session import _SHIPPED, local_path, ship_package, work_root

    ship_package(spark)
    ship_package(spark)  # idempotent
    assert spark.sparkContext.applicationId in _SHIPPED
    zips = glob.glob(local_path(work_root(spark)) + "/cellhouse-pkg/cellhouse-*.zip")
    assert zips
    import zipfile

    names = zipfile.ZipFile(zips[0]).namelist()
    assert "cellhouse/operators/partitions.py" in names and "cellhouse/__init__.py" in names


def test_leftover_staging_of_a_crashed_load(spark, tmp_table):
    # a driver that died mid-write leaves the table's own staging folder
    t = tmp_table(["f"])
    leftover = f"{t.path}/_staging/{t.next_load_id()}"
    spark.range(1).write.parquet(leftover + "/family=f/region=0")
    put(spark, t, [("r", "f", "q", 1, "x")])
    assert view(t) == [("r", "f", "q", 1, "x")]


def test_sweep_equals_broadcast_tombstones(spark):
    """Random logs: one exchange of puts and tombstones gives what the joins give."""
    import random

    from cellhouse.operators.visibility import swept, visible_cells

    r = random.Random(11)
    rows = []
    for i in range(4000):
        op = r.choices([4, 8, 12, 14], [400, 20, 4, 1])[0]
        rows.append((bytearray(r.choice([b"hot", b"a", b"b\xff"])), r.choice("fg"), bytearray(b"" if op == 14 else r.choice(
            [b"", b"p", b"q", b"r\x00"])), r.randrange(-5, 40 if op in (4, 8) else 30), op, None if op != 4 else bytearray(b"%d" % i), i, r.randrange(3)))
    schema = "row binary, family string, qualifier binary, ts long, op tinyint, value binary, seq long, load_id long"
    log = spark.createDataFrame(rows, schema).repartition(5)
    for versions in (1, 3, None):
        for ts_range in (None, (0, 20), (None, 30)):
            a, b = (sorted((bytes(x.row), x.family, bytes(x.qualifier), x.ts, x.value) for x in visible_cells(
                log, versions, ts_range, broadcast_bytes=n).collect()) for n in (1 << 30, 0))
            assert a == b and a
    plan = swept(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_rows_in_order_samples_and_writes_nothing(spark):
    from cellhouse.operators.sort import rows_in_order

    rows = [(bytearray(b"%05d" % (i * 7919 % 1000)),) for i in range(3000)] + [(bytearray(b""),), (bytearray(b"\xff"),)]
    out = rows_in_order(spark.createDataFrame(rows, "row binary"), [b"", b"00200", b"00900", b"00950"])
    want = {k: i for i, k in enumerate(sorted({bytes(x[0]) for x in rows}), 1)}
    assert {bytes(x.row): x["rank"] for x in out.collect()} == want and out.count() == len(want)
    plan = out._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "Scan ExistingRDD[_p" not in plan
