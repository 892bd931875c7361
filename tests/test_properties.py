"""Properties against a brute-force model, and a hot-key (skew) workload."""

import random

from pyspark.sql import functions as F

from cellhouse import fs, read_table
from cellhouse.operators.load import bulk_load, bulk_load_thin_rows
from cellhouse.operators.lookup import bulk_get
from cellhouse.operators.mutate import apply_mutations
from cellhouse.operators.partitions import map_partitions

SCHEMA = "row string, family string, qualifier string, ts long, value string, op int, seq long"
FAMS = ["f", "g"]


def model(loads, versions):
    """Plain-Python visibility: tombstones hide ts <= T (version: == T);
    same ts -> latest (load, seq); newest ``versions`` timestamps."""
    fam_del, col_del, ver_del, puts = {}, {}, set(), {}
    for li, rows in enumerate(loads):
        for row, fam, q, ts, value, op, seq in rows:
            fams = FAMS if (op == 14 and fam is None) else [fam]
            for f in fams:
                if op == 14:
                    fam_del[(row, f)] = max(fam_del.get((row, f), ts), ts)
                elif op == 12:
                    col_del[(row, f, q)] = max(col_del.get((row, f, q), ts), ts)
                elif op == 8:
                    ver_del.add((row, f, q, ts))
                else:
                    k = (row, f, q, ts)
                    if k not in puts or (li, seq) > puts[k][0]:
                        puts[k] = ((li, seq), value)
    cols = {}
    for (row, f, q, ts), (_, value) in puts.items():
        if ts <= fam_del.get((row, f), -1) or ts <= col_del.get((row, f, q), -1) or (row, f, q, ts) in ver_del:
            continue
        cols.setdefault((row, f, q), []).append((ts, value))
    out = []
    for (row, f, q), vs in cols.items():
        vs.sort(reverse=True)
        for ts, value in vs[: versions or len(vs)]:
            out.append((row, f, q, ts, value))
    return sorted(out)


def random_loads(rnd, n_loads=3, n=80):
    loads, seq = [], 0
    for _ in range(n_loads):
        rows = []
        for _ in range(n):
            op = rnd.choice([4, 4, 4, 4, 4, 8, 12, 14, 14])
            row, q, ts = f"r{rnd.randint(0, 6)}", f"q{rnd.randint(0, 2)}", rnd.randint(1, 8)
            fam = None if (op == 14 and rnd.random() < 0.5) else rnd.choice(FAMS)
            rows.append((row, fam, "" if op == 14 else q, ts, f"v{seq}" if op == 4 else None, op, seq))
            seq += 1
        loads.append(rows)
    return loads


def test_visibility_matches_model(spark, tmp_table):
    for seed in range(3):
        rnd = random.Random(seed)
        loads = random_loads(rnd)
        t = tmp_table(FAMS, splits=["r2", "r5"])
        for rows in loads:
            apply_mutations(t, spark.createDataFrame(rows, SCHEMA))
        for versions in (1, 2, None):
            got = sorted((bytes(r.row).decode(), r.family, bytes(r.qualifier).decode(), r.ts,
                          bytes(r.value).decode()) for r in read_table(t, versions=versions).collect())
            assert got == model(loads, versions), (seed, versions)


def test_hot_row_third_of_data(spark, tmp_table):
    # one row key holds a third of all cells
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("k%06d", "id")).alias("row"),
        F.lit("f").alias("family"), F.format_string("q%06d", "id").alias("qualifier"),
        (F.col("id") % 5).alias("ts"), F.col("id").cast("string").alias("value"))
    t = tmp_table(["f"], splits=["k1", "k5"])
    # tiny data would be coalesced into one task by AQE (rightly); switch
    # coalescing off to see the spreading of the hot region itself
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        r = bulk_load(t, df)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # the hot row's region is written by more than one task
    hot_region = [m for m in t.manifest().collect() if m.min_row <= b"hot" <= m.max_row][0]
    assert hot_region.n_files > 1
    assert read_table(t).count() == n
    hot = read_table(t, start_row="hot", stop_row="hot\x00")
    assert hot.count() == n // 3
    # lookups with a hot request key keep every request
    req = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.format_string("k%06d", F.col("id") * 3 + 1)).alias("row"))
    got = bulk_get(req, t, [("f", "q000000", "v")])
    # a restricted get finds a row only through the requested column
    assert got.count() == 3000 and got.where("found").count() == 1000
    assert got.where("found").where(F.col("row") != "hot").count() == 0
    # keyed map with pre-aggregation: the hot key is combined map-side
    schema = spark.createDataFrame([], "n long").schema

    def part(conf, key, batches):
        return [(sum(b.num_rows for b in batches),)]

    def final(conf, key, batches):
        return [(sum(sum(b.column("n").to_pylist()) for b in batches),)]

    counts = map_partitions(df.repartition(6), "row", final, schema, partial=part, partial_schema=schema)
    assert counts.where(F.col("key") == "hot").first()["n"] == n // 3
    assert counts.count() == n - n // 3 + 1
    assert fs.count_files(spark, r.path) >= 2


def test_thin_rows_hot_row(spark, tmp_table):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("k%05d", "id")).alias("k"),
        F.col("id"))
    cells = F.array(F.struct(F.lit("f").alias("family"), F.format_string("a%05d", "id").alias("qualifier"),
                             F.col("id").cast("string").alias("value")),
                    F.struct(F.lit("f").alias("family"), F.format_string("b%05d", "id").alias("qualifier"),
                             F.col("id").cast("string").alias("value")))
    t = tmp_table(["f"], splits=["k2"])
    bulk_load_thin_rows(t, df, F.col("k"), cells, ts=1)
    assert read_table(t).count() == 12000
