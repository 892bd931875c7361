"""Wide-cell tables on parquet.

Layout of a table directory::

    _meta/                      one row: families, region starts, family options
    data/load_id=L/family=F/region=R/part-*.parquet     cell files of load L
    _manifest/load_id=L/part-*.parquet                  per (family, region) stats

A load becomes visible when its manifest directory appears (an atomic
directory rename).  Readers take only load ids with a manifest and skip
(load, family, region) groups that a later compaction replaced, so a
publish is all-or-nothing for readers.  Single writer per table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fs
from ..functions.regions import as_bytes, region_bounds, regions_for_range, table_starts
from ..model import (BROADCAST_BYTES, CELL_COLUMNS, CELL_SCHEMA, DELETE_COLUMN, DELETE_FAMILY, DELETE_VERSION, MANIFEST_SCHEMA,
                     META_SCHEMA, PUT, RANKED_BYTES, STORED_SCHEMA)

LOAD_ID_WIDTH = 12
#: manifest column that counts each kind of tombstone
DEL_COUNTS = {DELETE_FAMILY: "n_family_del", DELETE_COLUMN: "n_column_del", DELETE_VERSION: "n_version_del"}


def group_of(e: dict) -> str:
    return f"{e['load_id']}/{e['family']}/{e['region']}"


@dataclass
class CellTable:
    spark: SparkSession
    path: str
    families: list[str]
    starts: list[bytes]
    family_options: dict = field(default_factory=dict)
    _manifests: dict = field(default_factory=dict, repr=False, compare=False)

    @property
    def data_path(self) -> str:
        return f"{self.path}/data"

    @property
    def manifest_path(self) -> str:
        return f"{self.path}/_manifest"

    def load_path(self, load_id: str) -> str:
        return f"{self.data_path}/load_id={load_id}"

    def region_ranges(self):
        return region_bounds(self.starts)

    # -- manifest -----------------------------------------------------------
    def manifest(self) -> DataFrame:
        if not fs.list_dirs(self.spark, self.manifest_path):
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(self.manifest_path)

    def committed_loads(self) -> list[str]:
        return sorted(
            d.split("=", 1)[1] for d in fs.list_dirs(self.spark, self.manifest_path) if d.startswith("load_id=")
        )

    def entries(self) -> list:
        """Manifest rows (one small row per load, family and region) of the
        committed loads.  A load's manifest never changes, so each is read
        once per handle; loads published through this handle are not read at
        all.  As many rows as the file listing of a scan has folders."""
        loads = self.committed_loads()
        new = [x for x in loads if x not in self._manifests]
        if new:
            got = {x: [] for x in new}
            for r in self.manifest().where(F.col("load_id").isin(new)).collect():
                got[r.load_id].append(r.asDict())
            self._manifests.update(got)
        return [e for x in loads for e in self._manifests[x]]

    def replaced_groups(self) -> list[str]:
        """``load/family/region`` groups superseded by compactions."""
        return sorted({g for e in self.entries() for g in e["replaces"]})

    def live_entries(self) -> list:
        entries = self.entries()
        replaced = {g for e in entries for g in e["replaces"]}
        return [e for e in entries if group_of(e) not in replaced]

    def tombstones(self, families=None, regions=None) -> tuple[list[str], set, int]:
        """Live loads with tombstones in scope, the kinds present and their
        bytes -- from the manifest, without a job over the data."""
        loads, kinds, size = set(), set(), 0
        for e in self.live_entries():
            if families is not None and e["family"] not in families:
                continue
            if regions is not None and not regions[0] <= e["region"] <= regions[1]:
                continue
            here = {k for k, c in DEL_COUNTS.items() if e[c]}
            if here:
                loads.add(e["load_id"])
                kinds |= here
                size += e["del_bytes"]
        return sorted(loads), kinds, size

    def live_bytes(self, families=None, regions=None) -> int:
        """Bytes of the live files in scope, from the manifest."""
        return sum(e["n_bytes"] for e in self.live_entries()
                   if (families is None or e["family"] in families)
                   and (regions is None or regions[0] <= e["region"] <= regions[1]))

    def next_load_id(self) -> str:
        used = [d.split("=", 1)[1] for d in fs.list_dirs(self.spark, self.data_path) if d.startswith("load_id=")]
        used += self.committed_loads()
        n = max((int(u) for u in used if u.isdigit()), default=0) + 1
        return str(n).zfill(LOAD_ID_WIDTH)

    def resolved_versions(self, families=None, regions=None):
        """If every live (family, region) group in scope holds exactly one
        entry and it is a major compaction, the versions it kept per column
        (``None`` = all); else ``False``.  Such groups are already resolved:
        no tombstones, one cell per version.  Decided on the cached manifest
        entries; ``False`` at once while no compaction ever ran."""
        groups = {}
        for e in self.live_entries():
            fam, region = e["family"], e["region"]
            if families is not None and fam not in families:
                continue
            if regions is not None and not regions[0] <= region <= regions[1]:
                continue
            groups.setdefault((fam, region), []).append((e["kind"], e["versions_kept"]))
        if not groups or any(len(v) != 1 or v[0][0] != "major" for v in groups.values()):
            return False
        kept = {v[0][1] for v in groups.values()}
        if kept == {None}:
            return None
        return False if None in kept else max(kept)

    # -- reads --------------------------------------------------------------
    def stored(self) -> DataFrame:
        """All committed, non-replaced cells with ``load_id`` and ``region``."""
        # only loads with a live group that holds cells, and only the replaced
        # groups of those loads need excluding
        keep = {e["load_id"] for e in self.live_entries() if e["n_cells"]}
        if not keep:
            return self.spark.createDataFrame([], STORED_SCHEMA)
        replaced = [g for g in self.replaced_groups() if g.split("/", 1)[0] in keep]
        df = self.spark.read.schema(STORED_SCHEMA).parquet(self.data_path).where(F.col("load_id").isin(sorted(keep)))
        if replaced:
            key = F.concat_ws("/", "load_id", "family", F.col("region").cast("string"))
            df = df.where(~key.isin(replaced))
        return df


def _meta_path(path: str) -> str:
    return f"{path}/_meta"


def create_table(spark: SparkSession, path: str, families, split_keys=(), family_options: dict | None = None) -> CellTable:
    """Create a table with families and region split keys, only if it is
    not there yet (then the stored definition is returned unchanged)."""
    if fs.exists(spark, _meta_path(path)) or fs.exists(spark, f"{path}/_meta_new/_SUCCESS"):
        return open_table(spark, path)
    fams = sorted(dict.fromkeys(families))
    if not fams:
        raise ValueError("a table needs at least one family")
    starts = table_starts(split_keys)
    opts = {f: dict((family_options or {}).get(f, {})) for f in fams}
    meta = spark.createDataFrame([(fams, [bytearray(s) for s in starts], opts)], META_SCHEMA)
    meta.coalesce(1).write.mode("errorifexists").parquet(_meta_path(path))
    fs.mkdirs(spark, f"{path}/data")
    return open_table(spark, path)


def open_table(spark: SparkSession, path: str) -> CellTable:
    meta = _meta_path(path)
    if not fs.exists(spark, meta) and fs.exists(spark, f"{path}/_meta_new/_SUCCESS"):
        meta = f"{path}/_meta_new"  # a change of the definition broke off between its two renames
    m = spark.read.schema(META_SCHEMA).parquet(meta).first()
    if m is None:
        raise FileNotFoundError(f"no table at {path}")
    return CellTable(
        spark,
        path,
        list(m.families),
        [bytes(s) for s in m.region_starts],
        {k: dict(v or {}) for k, v in (m.family_options or {}).items()},
    )


def read_cells(
    table: CellTable,
    start_row=None,
    stop_row=None,
    families=None,
    qualifiers=None,
    with_region: bool = False,
) -> DataFrame:
    """Raw cell log (puts and tombstones) restricted by plain predicates.

    Row range -> parquet ``row`` filters plus a ``region`` partition range
    (two driver-side bisects over the start keys); families -> partition
    filter.  A qualifier restriction keeps family tombstones (qualifier
    ``X''``), so it can be applied before visibility resolution.
    """
    df = table.stored()
    if families is not None:
        fams = list(families)
        unknown = set(fams) - set(table.families)
        if unknown:
            raise ValueError(f"unknown families {sorted(unknown)}")
        df = df.where(F.col("family").isin(fams))
    if start_row is not None or stop_row is not None:
        lo_b = as_bytes(start_row) if start_row is not None else None
        hi_b = as_bytes(stop_row) if stop_row is not None else None
        lo, hi = regions_for_range(table.starts, lo_b, hi_b)
        df = df.where(F.col("region").between(lo, hi))
        if lo_b is not None:
            df = df.where(F.col("row") >= F.lit(bytearray(lo_b)))
        if hi_b is not None:
            df = df.where(F.col("row") < F.lit(bytearray(hi_b)))
    if qualifiers is not None:
        qs = [bytearray(as_bytes(q)) for q in qualifiers]
        df = df.where(F.col("qualifier").isin(qs) | (F.col("op") == F.lit(DELETE_FAMILY)))
    arrival = F.coalesce(F.col("src_load"), F.col("load_id")).alias("load_id")
    cols = [F.col(c) for c in CELL_COLUMNS] + [arrival, F.col("load_id").alias("_load")]
    return df.select(*cols, *([F.col("region")] if with_region else []))


def read_table(
    table: CellTable,
    start_row=None,
    stop_row=None,
    families=None,
    qualifiers=None,
    ts_range=None,
    versions: int | None = 1,
    broadcast_bytes: int = BROADCAST_BYTES,
    ranked_bytes: int = RANKED_BYTES,
) -> DataFrame:
    """Visible cells (newest ``versions`` per column, tombstones
    applied) as ``row, family, qualifier, ts, value``.  Tombstones of more than
    ``broadcast_bytes`` are resolved by a sweep.  In files of more than ``ranked_bytes``
    the columns with several puts are looked for first (one action)."""
    cells = read_cells(table, start_row, stop_row, families, qualifiers)
    regions = None
    if start_row is not None or stop_row is not None:
        regions = regions_for_range(table.starts, as_bytes(start_row) if start_row is not None else None,
                                    as_bytes(stop_row) if stop_row is not None else None)
    find_repeated = table.live_bytes(families, regions) > ranked_bytes
    return resolve(table, cells, versions, ts_range, families, regions, broadcast_bytes, find_repeated)


def known_tombstones(table: CellTable, cells: DataFrame, families=None, regions=None):
    """What the manifest tells of the tombstones among ``cells`` (from
    ``read_cells``): the rows of the loads that hold some."""
    loads, kinds, size = table.tombstones(families, regions)
    return cells.where(F.col("_load").isin(loads)) if loads else cells, kinds, size


def resolve(table: CellTable, cells: DataFrame, versions=1, ts_range=None, families=None, regions=None,
            broadcast_bytes: int = BROADCAST_BYTES, find_repeated: bool = False) -> DataFrame:
    """Visible cells of ``cells`` read from ``table``.  Groups written by a
    major compaction (and nothing since) are resolved already -- no
    tombstones, one cell per version, at most ``versions_kept`` versions --
    so they need no shuffle; everything else goes through ``visible_cells``."""
    from ..operators.visibility import in_ts_range, visible_cells

    kept = table.resolved_versions(families, regions)
    if kept is not False and (versions is None or (kept is not None and kept <= versions)):
        return in_ts_range(cells.where(F.col("op") == F.lit(PUT)), ts_range).select(
            "row", "family", "qualifier", "ts", "value")
    return visible_cells(cells, versions=versions, ts_range=ts_range, broadcast_bytes=broadcast_bytes,
                         known=known_tombstones(table, cells, families, regions), find_repeated=find_repeated)


__all__ = ["CellTable", "create_table", "open_table", "read_cells", "read_table", "CELL_SCHEMA"]
