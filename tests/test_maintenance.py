"""P2-P8 and properties: compaction and load order never change what a
reader sees."""

import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cellhouse import fs, read_table
from cellhouse.operators.load import bulk_load
from cellhouse.operators.maintain import compact, set_family_options, vacuum
from cellhouse.operators.mutate import apply_mutations
from cellhouse.session import local_path

SCHEMA = "row string, family string, qualifier string, ts long, value string, op int, seq long"


def snapshot(t, versions=1):
    return sorted((bytes(r.row), r.family, bytes(r.qualifier), r.ts, bytes(r.value))
                  for r in read_table(t, versions=versions).collect())


def random_batches(seed, n_batches=4, n=60):
    rnd = random.Random(seed)
    out = []
    seq = 0
    for _ in range(n_batches):
        rows = []
        for _ in range(n):
            op = rnd.choice([4, 4, 4, 4, 8, 12, 14])
            row, fam, q, ts = f"r{rnd.randint(0, 9)}", rnd.choice(["f", "g"]), f"q{rnd.randint(0, 2)}", rnd.randint(1, 6)
            rows.append((row, fam, q, ts, f"v{seq}" if op == 4 else None, op, seq))
            seq += 1
        out.append(rows)
    return out


def load_all(spark, t, batches, order=None):
    for i in order or range(len(batches)):
        apply_mutations(t, spark.createDataFrame(batches[i], SCHEMA))


def test_read_ranks_only_repeated_columns(spark, tmp_table):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def cells(df):
        return sorted((bytes(r.row), r.family, bytes(r.qualifier), r.ts, bytes(r.value)) for r in df.collect())

    t = tmp_table(["f", "g"], splits=["r3", "r6"])
    load_all(spark, t, random_batches(3))  # columns with many puts and tombstones of all kinds
    alone = [(f"s{i}", "f", "q", 1, f"a{i}", 4, i) for i in range(50)]
    bulk_load(t, spark.createDataFrame(alone, SCHEMA))
    for kw in ({"versions": 1}, {"versions": 2, "ts_range": (2, 5)}, {"versions": None, "start_row": "r5"}):
        want = cells(read_table(t, **kw))
        assert want
        assert cells(read_table(t, ranked_bytes=0, **kw)) == want
    from cellhouse.operators.visibility import newest_of_repeated, newest_versions
    from cellhouse.sources.table import read_cells

    log = read_cells(t)
    puts = log.where("op = 4")
    # more repeated columns than may be broadcast: all are ranked
    assert cells(newest_of_repeated(log, puts, 1, 1)) == cells(newest_versions(puts, 1))
    # every column has one put: the read moves no cell
    t2 = tmp_table(["f"], splits=["s3"])
    bulk_load(t2, spark.createDataFrame(alone, SCHEMA))
    got = read_table(t2, ranked_bytes=0)
    assert "Exchange" not in plan(got) and "Sort" not in plan(got)
    assert cells(got) == sorted((r.encode(), f, q.encode(), ts, v.encode()) for r, f, q, ts, v, _, _ in alone)


def test_compaction_keeps_visible_cells(spark, tmp_table):
    for seed in (1, 2):
        t = tmp_table(["f", "g"], splits=["r3", "r6"])
        load_all(spark, t, random_batches(seed))
        before1, before3 = snapshot(t), snapshot(t, versions=3)
        assert compact(t, max_files=1) is not None
        assert snapshot(t) == before1 and snapshot(t, versions=3) == before3
        compact(t, major=True)
        assert snapshot(t) == before1 and snapshot(t, versions=3) == before3
        # after a major compaction no tombstone remains on disk
        assert t.stored().where(F.col("op") != 4).count() == 0


def test_independent_loads_commute(spark, tmp_table):
    # loads touching disjoint columns: their order cannot matter
    rows_a = [(f"r{i}", "f", "q", i, f"a{i}", 4, i) for i in range(20)]
    rows_b = [(f"r{i}", "g", "q", i, f"b{i}", 4, i) for i in range(20)] + [("r3", "g", "", 9, None, 14, 99)]
    t1, t2 = tmp_table(["f", "g"]), tmp_table(["f", "g"])
    load_all(spark, t1, [rows_a, rows_b])
    load_all(spark, t2, [rows_a, rows_b], order=[1, 0])
    assert snapshot(t1) == snapshot(t2)


def test_exclude_from_minor(spark, tmp_table):
    t = tmp_table(["f"])
    df = spark.createDataFrame([("r", "f", "q", 1, "x", 4, 0)], SCHEMA)
    keep = bulk_load(t, df, exclude_from_minor=True)
    bulk_load(t, df.withColumn("ts", F.lit(2)))
    bulk_load(t, df.withColumn("ts", F.lit(3)))
    compact(t, max_files=1)
    assert keep.load_id in t.committed_loads()
    assert fs.exists(spark, t.load_path(keep.load_id) + "/family=f")
    assert snapshot(t, versions=None) == [(b"r", "f", b"q", ts, b"x") for ts in (1, 2, 3)]


def test_compaction_comes_to_an_end(spark, tmp_table):
    t = tmp_table(["f", "g"], splits=["r3", "r6"])
    load_all(spark, t, random_batches(5))
    before = snapshot(t)
    assert compact(t, max_files=2) is not None
    assert compact(t, max_files=2) is None
    # replaced folders stay for readers planned before, until vacuum
    planned = read_table(t)
    assert compact(t, major=True) is not None
    assert len(planned.collect()) == len(before)
    assert not any(p.startswith(t.data_path) for p in vacuum(t, retention_ms=3_600_000))
    assert any(p.startswith(t.data_path) for p in vacuum(t)) and snapshot(t) == before


def test_group_emptied_by_a_major_compaction(spark, tmp_table):
    t = tmp_table(["f"], splits=["m"])
    rows = [("a", "f", "q", 1, "x", 4, 0), ("z", "f", "q", 1, "y", 4, 1)]
    load_all(spark, t, [rows, [("a", "f", "", 9, None, 14, 2)]])
    compact(t, major=True)
    assert t.resolved_versions() is None and snapshot(t) == [(b"z", "f", b"q", 1, b"y")]
    assert sorted((e["region"], e["n_cells"]) for e in t.live_entries()) == [(0, 0), (1, 1)]


def test_merge_over_the_limit_on_load(spark, tmp_table):
    t = tmp_table(["f"])
    df = spark.createDataFrame([("r", "f", "q", 1, "x", 4, 0)], SCHEMA)
    for i in range(4):
        bulk_load(t, df.withColumn("ts", F.lit(i)), merge_over=2)
    assert sum(e["n_files"] for e in t.live_entries()) <= 3
    assert len(snapshot(t, versions=None)) == 4


def test_definition_survives_a_broken_change(spark, tmp_table):
    from cellhouse import open_table

    t = tmp_table(["f"])
    set_family_options(t, "f", compression="gzip")
    assert fs.rename(spark, f"{t.path}/_meta", f"{t.path}/_meta_new")  # as between the two renames
    assert open_table(spark, t.path).family_options == {"f": {"compression": "gzip"}}


def test_vacuum_removes_orphans(spark, tmp_table):
    t = tmp_table(["f"])
    df = spark.createDataFrame([("r", "f", "q", 1, "x", 4, 0)], SCHEMA)
    bulk_load(t, df)
    orphan = t.load_path("000000000099")
    spark.range(1).write.parquet(orphan + "/family=f/region=0")
    before = snapshot(t)
    removed = vacuum(t)
    assert orphan in removed and not fs.exists(spark, orphan)
    assert snapshot(t) == before


def test_file_rolling(spark, tmp_table):
    t = tmp_table(["f"])
    df = spark.range(3000).select(F.format_string("r%05d", "id").alias("row"), F.lit("f").alias("family"),
                                  F.lit("q").alias("qualifier"), F.lit(1).cast("long").alias("ts"),
                                  F.repeat(F.lit("x"), 200).alias("value"))
    r = bulk_load(t, df, file_bytes=64 * 1024)
    assert fs.count_files(spark, r.path) > 5
    assert read_table(t).count() == 3000


def test_file_rolling_needs_no_task_per_file(spark, tmp_table):
    # files roll inside the usual write tasks: a small target makes no more tasks
    import glob
    import os

    t = tmp_table(["f"], splits=[])
    df = spark.range(0, 24000, 1, 8).select(
        F.format_string("r%05d", "id").alias("row"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
        F.lit(1).cast("long").alias("ts"), F.concat(F.sha2(F.col("id").cast("string"), 512),
                                                    F.sha2((-F.col("id")).cast("string"), 512)).alias("value"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    r = bulk_load(t, df, file_bytes=64 * 1024)
    assert spark.conf.get(key, None) == before
    names = [os.path.basename(f) for f in glob.glob(local_path(r.path) + "/family=f/region=*/*.parquet")]
    tasks = {n.split("-")[1] for n in names}
    per_file = 64 * 1024 // (6 + 1 + 1 + 9 + 256)
    assert len(tasks) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 24000 // per_file <= len(names) <= 24000 // per_file + len(tasks) + 1
    rows = [r["n"] for r in t.stored().groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n")).collect()]
    assert max(rows) <= per_file and sum(rows) == 24000


def test_family_options(spark, tmp_table):
    t = tmp_table(["f", "g"])
    set_family_options(t, "g", compression="gzip")
    df = spark.createDataFrame([("r", "f", "q", 1, "x", 4, 0), ("r", "g", "q", 1, "y", 4, 1)], SCHEMA)
    r = bulk_load(t, df)
    codecs = {}
    import glob
    for fam in ("f", "g"):
        f = glob.glob(local_path(r.path) + f"/family={fam}/region=*/*.parquet")[0]
        codecs[fam] = pq.ParquetFile(f).metadata.row_group(0).column(0).compression
    assert codecs["g"] == "GZIP" and codecs["f"] != "GZIP"
    assert len(snapshot(t)) == 2


def test_manifest_stats(spark, tmp_table):
    t = tmp_table(["f"], splits=["m"])
    df = spark.createDataFrame([("a", "f", "q", 5, "x", 4, 0), ("z", "f", "q", 7, "y", 4, 1),
                                ("b", "f", "q", 3, "w", 4, 2)], SCHEMA)
    bulk_load(t, df)
    m = sorted((r.region, r.n_cells, bytes(r.min_row), bytes(r.max_row), r.min_ts, r.max_ts)
               for r in t.manifest().collect())
    assert m == [(0, 2, b"a", b"b", 3, 5), (1, 1, b"z", b"z", 7, 7)]



def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_manifest_statistics_do_not_sort_the_cells(spark, tmp_table):
    from cellhouse.operators.load import file_statistics

    t = tmp_table(["f"], splits=["m"])
    apply_mutations(t, spark.createDataFrame([("a", "f", "q", 5, "x", 4, 0), ("z", "f", "q", 7, None, 12, 1),
                                              ("b", "f", "q", 3, "w", 4, 2)], SCHEMA))
    got = file_statistics(spark.read.schema(t.stored().schema).parquet(t.data_path))
    plan = _plan(got)
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan
    rows = sorted((r.region, r.n_cells, bytes(r.min_row), bytes(r.max_row), r.min_ts, r.max_ts, r.col, r["size"] > 0)
                  for r in got.collect())
    assert rows == [(0, 2, b"a", b"b", 3, 5, 0, True), (1, 1, b"z", b"z", 7, 7, 1, True)]


def test_major_compacted_groups_read_without_shuffle(spark, tmp_table):
    t = tmp_table(["f", "g"], splits=["r3", "r6"])
    load_all(spark, t, random_batches(7))
    before = snapshot(t)
    compact(t, major=True, keep_versions=1)
    assert t.resolved_versions() == 1
    assert "Exchange" not in _plan(read_table(t))
    assert snapshot(t) == before
    # versions=3 on groups holding one version each is resolved too
    assert snapshot(t, versions=3) == before
    # a new load touches the groups: reads resolve versions again
    apply_mutations(t, spark.createDataFrame([("r1", "f", "q0", 99, "new", 4, 10_000)], SCHEMA))
    assert t.resolved_versions() is False
    assert "Exchange" in _plan(read_table(t))
    assert (b"r1", "f", b"q0", 99, b"new") in snapshot(t)


def test_a_sweep_makes_a_pass_only_for_the_tombstones_there(spark, tmp_table):
    from cellhouse.model import DELETE_COLUMN, DELETE_FAMILY, DELETE_VERSION
    from cellhouse.operators.visibility import swept

    rows = [("r", "f", "q", 1, "a", 4, 0), ("r", "f", "q", 3, "b", 4, 1), ("r", "f", "q", 3, "c", 4, 2), ("s", "f", "q", 5, "d", 4, 3),
            ("r", "f", "p", 2, "e", 4, 4), ("s", "f", "o", 9, "g", 4, 5), ("t", "f", "q", 1, "h", 4, 6)]
    dels = {DELETE_FAMILY: [("r", "f", "", 1, None, 14, 7), ("r", "f", "", 2, None, 14, 8), ("s", "f", "", 5, None, 14, 9)],
            DELETE_COLUMN: [("r", "f", "q", 2, None, 12, 10), ("s", "f", "o", 9, None, 12, 11)],
            DELETE_VERSION: [("r", "f", "q", 3, None, 8, 12)]}
    passes = {}
    for kinds in ((DELETE_FAMILY,), (DELETE_COLUMN,), (DELETE_VERSION,), tuple(dels)):
        t = tmp_table(["f"])
        apply_mutations(t, spark.createDataFrame(rows + [d for k in kinds for d in dels[k]], SCHEMA))
        assert t.tombstones()[1] == set(kinds)
        for versions in (1, None):
            got = read_table(t, versions=versions, broadcast_bytes=0)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, read_table(t, versions=versions).collect()))
        passes[kinds] = _plan(got).count("Window [")
    assert passes[DELETE_FAMILY,] < passes[tuple(dels)] and passes[DELETE_COLUMN,] < passes[tuple(dels)]
    assert swept.__defaults__[-1] == tuple(dels)  # a caller that does not know has all kinds looked for
