"""P3/O3 compaction, P5 vacuum, P6 exclude flag, P8 family options.

Compaction never edits files in place: chosen (load, family, region)
groups are read, rewritten region-sorted into a *new* load whose manifest
lists the groups it replaces; ``vacuum`` removes the old folders later.  A reader sees either the old groups or the
new one, never both.  Cells keep their original arrival order through
``src_load``/``seq``, so ``visible_cells`` is unchanged by a compaction.
"""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from .. import fs
from ..functions.regions import region_index
from ..model import DEFAULT_MAX_FILES, MANIFEST_SCHEMA, PUT
from ..sources.table import CellTable, known_tombstones
from .load import LoadResult, publish, write_cells
from .visibility import visible_cells


def live_groups(table: CellTable):
    """Live manifest entries: one row per (load, family, region) group."""
    return table.spark.createDataFrame(
        [tuple(e[c] for c in MANIFEST_SCHEMA.names) for e in table.live_entries()], MANIFEST_SCHEMA)


def compaction_candidates(table: CellTable, max_files: int = DEFAULT_MAX_FILES, major: bool = False):
    """(family, region) -> list of load ids to merge (from the manifest).

    Minor: groups with more than ``max_files`` *small* files (under half the
    file target); only entries that hold some.  A group of full files is never
    chosen, however many it has, so repeated compactions come to an end."""
    per: dict[tuple, list] = {}
    for e in table.live_entries():
        if major or (e["n_small_files"] and not e["exclude_from_minor"]):
            per.setdefault((e["family"], e["region"]), []).append(e)
    return {k: sorted(e["load_id"] for e in es) for k, es in sorted(per.items())
            if major or sum(e["n_small_files"] for e in es) > max_files}


def compact(table: CellTable, max_files: int = DEFAULT_MAX_FILES, major: bool = False,
            keep_versions: int | None = None, file_bytes: int | None = None) -> LoadResult | None:
    """Merge small files.

    Minor (default): every (family, region) holding more than ``max_files``
    small files, loads flagged ``exclude_from_minor`` left out; all cells and
    tombstones are kept.  Major: every group of every load; tombstones are
    applied and dropped, and only ``keep_versions`` newest versions are kept
    (all when None).  The replaced folders stay until ``vacuum``: a reader
    that planned before the switch still finds them.
    """
    chosen = compaction_candidates(table, max_files, major)
    if not chosen:
        return None
    triples = [f"{l}/{f}/{r}" for (f, r), loads in chosen.items() for l in loads]
    g = F.concat_ws("/", "load_id", "family", F.col("region").cast("string"))
    src = table.stored().where(g.isin(triples))
    src = src.withColumn("_load", F.col("load_id")).withColumn("src_load", F.coalesce(F.col("src_load"), F.col("load_id")))
    cells = ["row", "family", "qualifier", "ts", "op", "value", "seq", "pos"]
    if major:
        log = src.select(*cells, F.col("src_load").alias("load_id"), "_load")
        vis = visible_cells(log, versions=keep_versions, keep_meta=True, known=known_tombstones(table, log))
        out = vis.select(*[F.lit(PUT).cast("tinyint").alias("op") if c == "op" else c for c in cells],
                         F.col("load_id").alias("src_load"))
        out = out.withColumn("region", region_index(F.col("row"), table.starts, presorted=True))
    else:
        out = src.select(*cells, "src_load", "region")
    load_id = table.next_load_id()
    staged = f"{table.path}/_staging/{load_id}"
    fs.delete(table.spark, staged)
    write_cells(table, out, staged, file_bytes, spread=False)
    rep = {(f, r): [f"{l}/{f}/{r}" for l in loads] for (f, r), loads in chosen.items()}
    return publish(table, staged, load_id, "major" if major else "minor", False, rep, keep_versions if major else None)


def vacuum(table: CellTable, retention_ms: int = 0) -> list[str]:
    """P5: remove load folders without a manifest, leftover staging and
    manifest temp folders, and groups replaced by a compaction at least
    ``retention_ms`` ago (readers planned before it may still use them).
    Lists first, deletes after; returns what was removed."""
    spark = table.spark
    committed = set(table.committed_loads())
    removed = []
    for d in fs.list_dirs(spark, table.data_path):
        if d.startswith("load_id=") and d.split("=", 1)[1] not in committed:
            removed.append(f"{table.data_path}/{d}")
    until = int(time.time() * 1000) - retention_ms
    for t in sorted({g for e in table.entries() if e["load_time"] <= until for g in e["replaces"]}):
        l, f, r = t.split("/")
        p = f"{table.load_path(l)}/family={f}/region={r}"
        if fs.exists(spark, p):
            removed.append(p)
    for extra in ("_staging", "_manifest_tmp"):
        p = f"{table.path}/{extra}"
        if fs.exists(spark, p):
            removed.append(p)
    for p in removed:
        fs.delete(spark, p)
    return removed


def set_family_options(table: CellTable, family: str, **options) -> CellTable:
    """Per-family parquet writer options (e.g. ``compression='zstd'``,
    ``parquet.block.size``, ``parquet.bloom.filter.enabled#row``) applied to
    later loads of that family; stored with the table definition."""
    from ..model import META_SCHEMA

    if family not in table.families:
        raise ValueError(f"unknown family {family}")
    opts = {f: dict(v) for f, v in (table.family_options or {}).items()}
    opts.setdefault(family, {}).update({k: str(v) for k, v in options.items()})
    spark = table.spark
    meta = spark.createDataFrame([(table.families, [bytearray(s) for s in table.starts], opts)], META_SCHEMA)
    new, now, old = (f"{table.path}/{n}" for n in ("_meta_new", "_meta", "_meta_old"))
    fs.delete(spark, new)
    meta.coalesce(1).write.parquet(new)
    # a complete definition is there at every step: open_table falls back on _meta_new
    fs.delete(spark, old)
    if not (fs.rename(spark, now, old) and fs.rename(spark, new, now)):
        raise OSError(f"could not replace the definition of {table.path}")
    fs.delete(spark, old)
    table.family_options = opts
    return table
