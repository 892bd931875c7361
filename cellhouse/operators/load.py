"""S11/S12 bulk loads, P1/P2/P4/P7 staged publish, O1 region sort.

A load is: normalise cells -> region index -> REBALANCE on (family, region)
-> sort inside each task -> ``partitionBy(family, region)`` parquet into a
staging folder (Spark's job commit) -> rename into the table -> manifest
(one aggregate over the written files, by file, then by group) ->
rename of the manifest folder, which is the publish point.

REBALANCE (an AQE hint) hash-partitions by (family, region) and splits any
partition above the advisory size, so a region holding a third of the data
is written by several tasks instead of one; each task's files are sorted.
"""

from __future__ import annotations

import time
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs
from ..functions.bytes import cell_size, now_millis
from ..functions.regions import region_index
from ..model import (DEFAULT_FILE_BYTES, DELETE_COLUMN, DELETE_FAMILY, DELETE_VERSION, MANIFEST_SCHEMA, PUT, VALID_OPS)
from ..sources.table import CellTable

def sort_keys():
    """O1: cell order inside a region (row, qualifier up; ts, op, seq down)."""
    return [F.col("family"), F.col("region"), F.col("row"), F.col("qualifier"), F.col("ts").desc(),
            F.col("op").desc(), F.col("seq").desc(), F.col("pos").desc()]


WRITE_COLS = ["row", "qualifier", "ts", "op", "value", "seq", "pos", "src_load", "family", "region"]


@dataclass
class LoadResult:
    load_id: str
    path: str
    kind: str


def _as_binary(df: DataFrame, name: str) -> F.Column:
    t = df.schema[name].dataType
    c = F.col(name)
    if isinstance(t, T.BinaryType):
        return c
    if isinstance(t, T.StringType):
        return F.encode(c, "UTF-8")
    return F.encode(c.cast("string"), "UTF-8")


def normalize_cells(df: DataFrame, table: CellTable, ts=None, op=None, keep=()) -> DataFrame:
    """Project a cell-shaped DataFrame to the stored cell columns.

    Missing or null ``ts`` -> ``ts`` argument or the clock; missing ``op`` ->
    PUT; missing ``seq`` -> a per-row id (deterministic for a deterministic
    input); missing ``pos`` -> 0.  ``keep`` columns are added as ``_by0`` ....  Rows with a null key part are dropped (a null cell is "no
    cell").  An unknown family or op code fails the job before publish.
    """
    cols = set(df.columns)
    given = F.lit(ts).cast("bigint") if ts is not None else now_millis()
    ts_c = F.coalesce(F.col("ts").cast("bigint"), given) if "ts" in cols else given
    pos_c = F.col("pos").cast("int") if "pos" in cols else F.lit(0)
    op_c = F.col("op").cast("tinyint") if "op" in cols else F.lit(op if op is not None else PUT).cast("tinyint")
    seq_c = F.col("seq").cast("bigint") if "seq" in cols else F.monotonically_increasing_id()
    fam_ok = F.col("_family_in").isin(table.families)
    family = F.when(fam_ok, F.col("_family_in")).otherwise(
        F.raise_error(F.concat(F.lit("unknown family: "), F.col("_family_in")))
    )
    value = _as_binary(df, "value") if "value" in cols else F.lit(None).cast("binary")
    src = F.col("src_load") if "src_load" in cols else F.lit(None).cast("string")
    out = df.select(
        _as_binary(df, "row").alias("row"),
        F.col("family").alias("_family_in"),
        _as_binary(df, "qualifier").alias("qualifier") if "qualifier" in cols else F.lit(b"").cast("binary").alias("qualifier"),
        ts_c.alias("ts"),
        op_c.alias("op"),
        value.alias("value"),
        seq_c.alias("seq"),
        pos_c.alias("pos"),
        src.alias("src_load"),
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(keep)],
    ).where(F.col("row").isNotNull() & F.col("_family_in").isNotNull() & F.col("qualifier").isNotNull())
    op_ok = F.col("op").isin(list(VALID_OPS))
    out = out.select(
        "row",
        family.alias("family"),
        "qualifier",
        "ts",
        F.when(op_ok, F.col("op")).otherwise(F.raise_error(F.lit("unsupported mutation op")).cast("tinyint")).alias("op"),
        F.when(F.col("op") == F.lit(PUT), F.col("value")).alias("value"),
        "seq",
        "pos",
        "src_load",
        *[f"_by{i}" for i in range(len(keep))],
    )
    return out


def with_region(cells: DataFrame, table: CellTable) -> DataFrame:
    return cells.withColumn("region", region_index(F.col("row"), table.starts, presorted=True))


def _records_per_file(cells: DataFrame, file_bytes: int | None) -> int:
    """P2 with an explicit byte target: rows per file from the mean size of
    all cells (one pass over the input)."""
    if not file_bytes:
        return 0
    avg = cells.agg(F.avg(cell_size()).alias("a")).first()["a"]
    return max(1, int(file_bytes // max(float(avg or 64.0), 1.0)))


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _task_bytes(spark, file_bytes: int | None, spread: bool) -> int | None:
    """Bytes that REBALANCE gives a write task (None: the session's advisory size).
    A ``file_bytes`` above the usual size makes tasks large enough for such files; a
    smaller one only rolls files inside a task.  Tasks as small as the files would each
    add folders, a commit and the last, partly filled file of every group they hold."""
    if not spread:
        return max(file_bytes or 0, DEFAULT_FILE_BYTES)
    usual = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(ADVISORY, "64m"))
    return file_bytes if file_bytes and file_bytes > usual else None


@contextmanager
def _advisory_size(spark, n_bytes: int | None):
    """While a load is written, REBALANCE makes tasks of about ``n_bytes``: it
    splits larger partitions and merges smaller ones."""
    key = ADVISORY
    before = spark.conf.get(key, None)
    if n_bytes:
        spark.conf.set(key, str(n_bytes))
    try:
        yield
    finally:
        if n_bytes:
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def spread_factor(table: CellTable, n_families: int | None = None) -> int:
    """Write tasks per (family, region): enough that a table with few
    regions still uses every shuffle partition (2x for balance), 1 once
    regions outnumber tasks -- then AQE's rebalance splits hot regions at
    map-output boundaries."""
    parts = int(table.spark.conf.get("spark.sql.shuffle.partitions", "200"))
    groups = max(1, (n_families or len(table.families)) * len(table.starts))
    return max(1, -(-2 * parts // groups))


def salt(row_col: str, factor: int) -> F.Column:
    return F.pmod(F.xxhash64(F.col(row_col)), F.lit(factor)) if factor > 1 else F.lit(0)


def write_cells(table: CellTable, cells: DataFrame, target: str, file_bytes: int | None = None,
                balanced: bool = False, sized: DataFrame | None = None, spread: bool = True) -> None:
    """Region-sorted parquet under ``target/family=/region=`` (O1).

    Files follow the session's advisory partition size through the rebalance;
    an explicit ``file_bytes`` rolls files by rows inside the tasks, and is used in its place
    where it is larger.  ``balanced=True`` means the
    caller already placed the rows (thin rows) and only the in-task sort
    remains; such callers pass ``sized``, a pre-exchange view of the cells, so
    sizing never runs the shuffle.  ``spread=False`` (compaction) writes each
    group with as few tasks as its bytes need.
    """
    if balanced:
        placed = cells
    else:
        factor = salt("row", spread_factor(table) if spread else 1)
        placed = cells.withColumn("_salt", factor).hint("rebalance", "family", "region", "_salt").drop("_salt")
    sorted_cells = placed.sortWithinPartitions(*sort_keys()).select(*WRITE_COLS)
    per_file = _records_per_file(sized if sized is not None else cells, file_bytes)
    fam_opts = {f: o for f, o in (table.family_options or {}).items() if o}
    with _advisory_size(table.spark, _task_bytes(table.spark, file_bytes, spread)):
        if not fam_opts:
            w = sorted_cells.write.mode("errorifexists").partitionBy("family", "region")
            if per_file:
                w = w.option("maxRecordsPerFile", per_file)
            w.parquet(target)
            return
        # Per-family writer options -> one write per family
        for fam in table.families:
            part = sorted_cells.where(F.col("family") == F.lit(fam)).drop("family")
            w = part.write.mode("errorifexists").partitionBy("region")
            for k, v in fam_opts.get(fam, {}).items():
                w = w.option(k, v)
            if per_file:
                w = w.option("maxRecordsPerFile", per_file)
            w.parquet(f"{target}/family={fam}")


def file_statistics(files: DataFrame) -> DataFrame:
    """Manifest columns by written file.  ``min`` and ``max`` of bytes alone would sort
    all cells of a task by file; ``collect_set`` (one size a file) makes this an
    aggregate over objects, which holds one row for each file of the task."""
    from .visibility import key_bytes

    def n_of(op):
        return F.count_if(F.col("op") == F.lit(op))

    return files.groupBy("family", "region", F.col("_metadata.file_path").alias("f")).agg(
        F.count(F.lit(1)).alias("n_cells"), F.min("row").alias("min_row"), F.max("row").alias("max_row"),
        F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"),
        F.element_at(F.collect_set("_metadata.file_size"), 1).alias("size"),
        n_of(DELETE_FAMILY).alias("fam"), n_of(DELETE_COLUMN).alias("col"), n_of(DELETE_VERSION).alias("ver"),
        F.sum(F.when(F.col("op") != F.lit(PUT), key_bytes()).otherwise(F.lit(0))).alias("del"))


def _manifest_rows(table: CellTable, load_dir: str, load_time: int, exclude_from_minor: bool, kind: str,
                   replaces_by_group: dict | None, versions_kept: int | None = None) -> list[tuple]:
    """Statistics of the written files, by file first, then folded to one
    row per (family, region).  A group that a compaction replaced and wrote
    nothing for gets a row with no cells, so its old entries are superseded."""
    from ..model import FILE_SCHEMA

    schema = T.StructType(list(FILE_SCHEMA.fields) + [T.StructField("family", T.StringType()),
                                                      T.StructField("region", T.IntegerType())])
    spark = table.spark
    replaces = dict(replaces_by_group or {})
    got = []
    if fs.has_files(spark, load_dir):
        by_file = file_statistics(spark.read.schema(schema).parquet(load_dir))
        got = by_file.groupBy("family", "region").agg(
            F.sum("n_cells"), F.min("min_row"), F.max("max_row"), F.min("min_ts"), F.max("max_ts"),
            F.count(F.lit(1)), F.count_if(F.col("size") < F.lit(DEFAULT_FILE_BYTES // 2)), F.sum("size"),
            F.sum("fam"), F.sum("col"), F.sum("ver"), F.sum("del")).collect()  # one row per written folder
    rows = [(*r, load_time, bool(exclude_from_minor), kind, replaces.pop((r[0], r[1]), []), versions_kept) for r in got]
    rows += [(f, r, 0, None, None, None, None, 0, 0, 0, 0, 0, 0, 0, load_time, bool(exclude_from_minor), kind, old,
              versions_kept) for (f, r), old in sorted(replaces.items())]
    return rows


def publish(table: CellTable, staged: str, load_id: str, kind: str, exclude_from_minor: bool = False,
            replaces_by_group: dict | None = None, versions_kept: int | None = None) -> LoadResult:
    """Move a staged load into the table, then commit its manifest.

    Readers see the load only once ``_manifest/load_id=...`` exists; that
    folder is written aside and renamed in one step.
    """
    spark = table.spark
    dst = table.load_path(load_id)
    if fs.exists(spark, staged):
        if not fs.rename(spark, staged, dst):
            raise OSError(f"could not move {staged} to {dst}")
    else:
        fs.mkdirs(spark, dst)
    rows = _manifest_rows(table, dst, int(time.time() * 1000), exclude_from_minor, kind, replaces_by_group,
                          versions_kept)
    schema = T.StructType(MANIFEST_SCHEMA.fields[:-1])
    tmp = f"{table.path}/_manifest_tmp/{load_id}"
    fs.delete(spark, tmp)
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("errorifexists").parquet(tmp)
    if not fs.rename(spark, tmp, f"{table.manifest_path}/load_id={load_id}"):
        raise OSError(f"could not commit manifest of load {load_id}")
    table._manifests[load_id] = [dict(zip(schema.names, r), load_id=load_id) for r in rows]
    return LoadResult(load_id, dst, kind)


def _stage_path(table: CellTable, staging: str | None, load_id: str) -> str:
    if staging:
        # Fail before any work when the staging target exists
        if fs.exists(table.spark, staging):
            raise FileExistsError(f"staging path already exists: {staging}")
        return staging
    own = f"{table.path}/_staging/{load_id}"
    # a leftover of a crashed, never-published attempt with this id (single
    # writer): the folder is private to the table and never visible
    fs.delete(table.spark, own)
    return own


def bulk_load(table: CellTable, cells: DataFrame, staging: str | None = None, exclude_from_minor: bool = False,
              ts=None, file_bytes: int | None = None, kind: str = "load", collapse=None,
              merge_over: int | None = None) -> LoadResult:
    """One input row -> one cell; region-sorted files, staged publish.

    ``cells`` has columns ``row, family, qualifier, value`` and optionally
    ``ts, op, seq`` (strings are UTF-8 encoded).  Blocks until published.
    ``collapse`` names the columns of ``cells`` that order arrivals (``True``:
    ``seq``): identical cells are then stored once, the last one's value.
    ``merge_over``: groups with more small files than this are merged after
    the publish.
    """
    load_id = table.next_load_id()
    target = _stage_path(table, staging, load_id)
    order = [] if not collapse or collapse is True else list(collapse)
    norm = normalize_cells(cells, table, ts=ts, keep=order)
    if collapse:
        from .visibility import collapse_identical

        names = [f"_by{i}" for i in range(len(order))] or ["seq"]
        norm = norm.withColumn("src_load", F.lit(None).cast("string"))
        norm = collapse_identical(norm, [*names, *(["seq", "pos"] if order else ["pos"])])
        norm = norm.drop(*names[: len(order)]).withColumn("src_load", F.lit(None).cast("string"))
    write_cells(table, with_region(norm, table), target, file_bytes)
    out = publish(table, target, load_id, kind, exclude_from_minor)
    if merge_over is not None:
        from .maintain import compact

        compact(table, max_files=merge_over)
    return out


def bulk_load_cells(table: CellTable, df: DataFrame, cell, **kw) -> LoadResult:
    """S11 with a cell expression (a struct column); null cells are dropped."""
    cells = df.select(cell.alias("_c")).where(F.col("_c").isNotNull()).select("_c.*")
    return bulk_load(table, cells, **kw)


def bulk_load_thin_rows(table: CellTable, df: DataFrame, row, cells, staging: str | None = None,
                        exclude_from_minor: bool = False, ts=None,
                        file_bytes: int | None = None) -> LoadResult:
    """One input row -> many cells of one row key.

    The *unexpanded* element travels through the exchange (keyed by the
    region of its row key, REBALANCE splits hot regions); the cells are
    generated after it, so the shuffle carries one record per row instead of
    one per cell.  ``cells`` is an array<struct<family, qualifier, value[, ts]>>
    column; null arrays and null elements are skipped.
    """
    load_id = table.next_load_id()
    target = _stage_path(table, staging, load_id)
    # the element itself travels: the cells expression is evaluated after the
    # exchange, so the shuffle carries the narrow input row and the cell
    # building runs in the (parallel) reduce tasks
    keyed = df.withColumn("_row", row).where(F.col("_row").isNotNull())
    keyed = keyed.withColumn("_row", F.col("_row") if isinstance(keyed.schema["_row"].dataType, T.BinaryType)
                             else F.encode(F.col("_row").cast("string"), "UTF-8"))
    keyed = keyed.withColumn("region", region_index(F.col("_row"), table.starts, presorted=True))
    # arrival order: the element's id (input partition, place in it), then the
    # place in the element, in a column of its own
    keyed = keyed.withColumn("_seq0", F.monotonically_increasing_id())
    moved = keyed.withColumn("_salt", salt("_row", spread_factor(table, 1))).hint("rebalance", "region", "_salt")

    def expand(elements: DataFrame) -> DataFrame:
        exploded = elements.select(
            "_row", "region", "_seq0", F.posexplode(cells).alias("_pos", "_cell")
        ).where(F.col("_cell").isNotNull())
        flat = exploded.select(
            F.col("_row").alias("row"),
            "_cell.*",
            F.col("_seq0").alias("seq"),
            F.col("_pos").alias("pos"),
        )
        norm = normalize_cells(flat, table, ts=ts)
        return norm.withColumn("region", region_index(F.col("row"), table.starts, presorted=True))

    write_cells(table, expand(moved), target, file_bytes, balanced=True, sized=expand(keyed))
    return publish(table, target, load_id, "thin_rows", exclude_from_minor)


@dataclass
class StagedLoad:
    load_id: str
    path: str


def stage(table: CellTable, cells: DataFrame, staging: str, ts=None,
          file_bytes: int | None = None) -> StagedLoad:
    """First half of S11: write region-sorted files to ``staging`` only.
    Nothing is visible to readers until ``publish_staged``."""
    load_id = table.next_load_id()
    target = _stage_path(table, staging, load_id)
    write_cells(table, with_region(normalize_cells(cells, table, ts=ts), table), target, file_bytes)
    return StagedLoad(load_id, target)


def publish_staged(table: CellTable, staged: StagedLoad, exclude_from_minor: bool = False) -> LoadResult:
    """Second half of S11: move the staged files in and commit."""
    return publish(table, staged.path, staged.load_id, "load", exclude_from_minor)
