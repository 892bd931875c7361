"""Put, delete and mixed-mutation sinks.

Every mutation is an appended cell (a put or a tombstone); nothing is
rewritten in place.  A call is one load: written, then published through
the manifest, so it is all-or-nothing for readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import DELETE_COLUMN, DELETE_FAMILY, DELETE_VERSION, PUT
from ..sources.table import CellTable
from .load import LoadResult, bulk_load

SCOPES = {"row": DELETE_FAMILY, "family": DELETE_FAMILY, "column": DELETE_COLUMN, "version": DELETE_VERSION}


def bulk_put(table: CellTable, cells: DataFrame, ts=None) -> LoadResult:
    """Append puts.  ``cells``: ``row, family, qualifier, value[, ts, seq]``.

    Only puts: an ``op`` column holding anything else fails the job before
    publish (deletes go through ``bulk_delete``; mixed collections through
    ``apply_mutations``)."""
    if "op" in cells.columns:
        ok = F.col("op") == F.lit(PUT)
        cells = cells.withColumn("op", F.when(ok, F.col("op")).otherwise(
            F.raise_error(F.lit("bulk_put takes puts only; use bulk_delete or apply_mutations"))))
    else:
        cells = cells.withColumn("op", F.lit(PUT))
    return bulk_load(table, cells, ts=ts, kind="put")


def put_expr(df: DataFrame, cell) -> DataFrame:
    """F1 for mutations: map each element to a cell struct, drop nulls."""
    return df.select(cell.alias("_m")).where(F.col("_m").isNotNull()).select("_m.*")


def tombstones(table: CellTable, deletes: DataFrame, scope: str = "row", ts=None) -> DataFrame:
    """Tombstone cells for ``deletes``.

    * ``row``: ``row`` -> one family tombstone for every family of the table
      (a row delete never needs a row-only key, so row/family predicates keep
      pushing down to parquet);
    * ``family``: ``row, family``;  ``column``: ``row, family, qualifier``;
    * ``version``: ``row, family, qualifier, ts`` (exact timestamp).

    ``ts`` (column ``ts`` or argument; default the clock) is the time of the
    tombstone: it hides puts with ``ts <=`` it.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {sorted(SCOPES)}")
    op = SCOPES[scope]
    d = deletes
    if scope == "row":
        d = d.select("row", *(["ts"] if "ts" in d.columns else []), *(["seq"] if "seq" in d.columns else []))
        d = d.withColumn("family", F.explode(F.array(*[F.lit(f) for f in table.families])))
    if scope in ("row", "family"):
        d = d.withColumn("qualifier", F.lit(bytearray(b"")))
    if scope == "version" and "ts" not in d.columns:
        raise ValueError("a version delete needs a ts column")
    if "ts" not in d.columns and ts is not None:
        d = d.withColumn("ts", F.lit(int(ts)).cast("bigint"))
    keep = [c for c in ("row", "family", "qualifier", "ts", "seq") if c in d.columns]
    return d.select(*keep).withColumn("op", F.lit(op).cast("tinyint"))


def bulk_delete(table: CellTable, deletes: DataFrame, scope: str = "row", ts=None) -> LoadResult:
    """Append tombstones (see ``tombstones``)."""
    return bulk_load(table, tombstones(table, deletes, scope, ts), kind="delete")


def apply_mutations(table: CellTable, mutations: DataFrame, ts=None) -> LoadResult:
    """One collection mixing puts and deletes, told apart by ``op``
    (4 put, 8 version, 12 column, 14 family delete).  Row deletes are
    expanded here to one family tombstone per family when ``family`` is
    null.  Any other op code fails the job before publish."""
    m = mutations
    if "family" in m.columns:
        fams = F.array(*[F.lit(f) for f in table.families])
        row_delete = (F.col("op") == F.lit(DELETE_FAMILY)) & F.col("family").isNull()
        m = m.withColumn("family", F.explode(F.when(row_delete, fams).otherwise(F.array(F.col("family")))))
    if "qualifier" in m.columns:
        m = m.withColumn(
            "qualifier",
            F.when(F.col("op") == F.lit(DELETE_FAMILY), F.lit(bytearray(b""))).otherwise(
                F.col("qualifier").cast("binary") if dict(m.dtypes)["qualifier"] == "binary"
                else F.encode(F.col("qualifier").cast("string"), "UTF-8")),
        )
    return bulk_load(table, m, ts=ts, kind="mutate")
