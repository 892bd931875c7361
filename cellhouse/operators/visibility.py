"""What a reader sees in an append-only cell log.

Rules (Bigtable/LSM semantics):

* a family tombstone at time T hides every put of that (row, family) with
  ``ts <= T``; a column tombstone the same for one (row, family, qualifier);
  a version tombstone hides exactly one ``ts`` of one column;
* tombstones win at equal time; a put with a later ``ts`` shows again;
* two puts of the same (row, family, qualifier, ts) are one version: the
  later arrival -- larger ``(load_id, seq)`` -- wins;
* a read returns the newest ``versions`` timestamps per column.

Plan shape.  Tombstones are aggregated first (partial + final hash
aggregates, so a hot key is combined map-side).  Their kinds and size come
from the manifest (for a plain DataFrame: one action), only loads that hold
some are scanned for them; when they fit ``BROADCAST_BYTES`` they are
broadcast and the puts never move for tombstone resolution.  Beyond it puts and tombstones go
through one exchange together and are resolved by a sweep (see ``swept``).  The newest-n step is a ``row_number``/
``dense_rank`` filter, which Catalyst turns into a ``WindowGroupLimit``
that also runs before the exchange: each map task ships at most n versions
per column, however hot the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..model import BROADCAST_BYTES, DELETE_COLUMN, DELETE_FAMILY, DELETE_VERSION, PUT
from ..session import work_root

#: bytes of a column's hash as a row of an in-memory hash relation
HASH_BYTES = 48
KEY_F = ["row", "family"]
KEY_Q = ["row", "family", "qualifier"]


def _arrival_order(df: DataFrame):
    cols = []
    if "load_id" in df.columns:
        cols.append(F.col("load_id").desc())
    if "seq" in df.columns:
        cols.append(F.col("seq").desc())
    if "pos" in df.columns:
        cols.append(F.col("pos").desc())
    return cols


def key_bytes():
    """Bytes of a tombstone as a row of an in-memory hash relation: its key
    parts plus the row header, the pointers and the hash slot."""
    return F.octet_length("row") + F.octet_length("family") + F.octet_length("qualifier") + F.lit(80)


def measure_tombstones(cells: DataFrame) -> tuple[set, int]:
    """Kinds of tombstones present and their bytes, by one action -- for cells
    that come without a manifest."""
    got = cells.where(F.col("op") != F.lit(PUT)).groupBy("op").agg(F.sum(key_bytes()).alias("b")).collect()
    return {int(r["op"]) for r in got}, sum(int(r["b"]) for r in got)


def tombstone_tables(tombs: DataFrame, kinds: set):
    """Family / column / version tombstone tables (None for an absent kind)."""
    tombs = tombs.select("row", "family", "qualifier", "ts", "op")
    fam = col = ver = None
    if DELETE_FAMILY in kinds:
        fam = tombs.where(F.col("op") == F.lit(DELETE_FAMILY)).groupBy(*KEY_F).agg(F.max("ts").alias("_fam_del"))
    if DELETE_COLUMN in kinds:
        col = tombs.where(F.col("op") == F.lit(DELETE_COLUMN)).groupBy(*KEY_Q).agg(F.max("ts").alias("_col_del"))
    if DELETE_VERSION in kinds:
        ver = tombs.where(F.col("op") == F.lit(DELETE_VERSION)).select(*KEY_Q, "ts").distinct()
    return fam, col, ver


def in_ts_range(puts: DataFrame, ts_range=None) -> DataFrame:
    """Puts with ``lo <= ts < hi`` (either bound may be None)."""
    if ts_range is not None:
        lo, hi = ts_range
        if lo is not None:
            puts = puts.where(F.col("ts") >= F.lit(int(lo)))
        if hi is not None:
            puts = puts.where(F.col("ts") < F.lit(int(hi)))
    return puts


def apply_tombstones(cells: DataFrame, ts_range, known: tuple[DataFrame, set, int]) -> DataFrame:
    """Puts that no tombstone hides (all versions, duplicates not merged), by
    broadcast tombstones: ``known`` tells where they are, their kinds and their
    bytes, which the caller has held against the bound."""
    puts = in_ts_range(cells.where(F.col("op") == F.lit(PUT)), ts_range)
    tombs, kinds, _ = known
    if not kinds:
        return puts
    fam, col, ver = tombstone_tables(tombs, kinds)
    side = F.broadcast
    out = puts
    if fam is not None:
        out = out.join(side(fam), KEY_F, "left").where(
            F.col("_fam_del").isNull() | (F.col("ts") > F.col("_fam_del"))).drop("_fam_del")
    if col is not None:
        out = out.join(side(col), KEY_Q, "left").where(
            F.col("_col_del").isNull() | (F.col("ts") > F.col("_col_del"))).drop("_col_del")
    if ver is not None:
        out = out.join(side(ver), KEY_Q + ["ts"], "left_anti")
    return out


def newest_versions(puts: DataFrame, versions: int | None = 1) -> DataFrame:
    """Newest ``versions`` distinct timestamps per column; for each timestamp
    the latest arrival.  ``versions=None`` keeps every timestamp.

    Each form is a rank filter that Catalyst turns into a ``WindowGroupLimit``
    with a partial step before the single exchange (at most n timestamps per
    column leave a map task); the per-timestamp dedup reuses that
    partitioning (no second exchange).
    """
    arrival = _arrival_order(puts)
    if versions == 1:
        w = Window.partitionBy(*KEY_Q).orderBy(F.col("ts").desc(), *arrival)
        return puts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    w_ts = Window.partitionBy(*KEY_Q, "ts").orderBy(*arrival) if arrival else Window.partitionBy(*KEY_Q, "ts").orderBy("ts")
    if versions is None:
        return puts.withColumn("_rn", F.row_number().over(w_ts)).where(F.col("_rn") == 1).drop("_rn")
    w = Window.partitionBy(*KEY_Q).orderBy(F.col("ts").desc())
    top = puts.withColumn("_dr", F.dense_rank().over(w)).where(F.col("_dr") <= int(versions)).drop("_dr")
    return top.withColumn("_rn", F.row_number().over(w_ts)).where(F.col("_rn") == 1).drop("_rn")


def newest_of_repeated(cells: DataFrame, puts: DataFrame, versions: int | None = 1,
                       broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``newest_versions`` of ``puts``, where only columns with several puts move.

    The only put of a column is its newest version whatever its time, so it needs
    neither exchange nor sort.  One action counts the puts (of ``cells``, before
    tombstones: at least as many) by a 64-bit hash of the column: the exchange carries
    a hash and a count for each cell, combined in the map tasks first.  Columns
    whose hash comes more than once -- by chance too -- are ranked as always, told apart by a
    broadcast of the hashes; if these do not fit ``broadcast_bytes``, all are ranked.
    """
    if versions is not None and versions < 1:
        return newest_versions(puts, versions)
    column = F.xxhash64(*KEY_Q)
    counts = cells.where(F.col("op") == F.lit(PUT)).groupBy(column.alias("_column")).agg(
        F.count(F.lit(1)).alias("_n"))
    repeated = counts.where(F.col("_n") > 1).select("_column")
    n = repeated.count()
    if n == 0:
        return puts
    if n * HASH_BYTES > broadcast_bytes:
        return newest_versions(puts, versions)
    work_root(cells.sparkSession)  # make sure a checkpoint folder is set
    repeated = F.broadcast(repeated.checkpoint(eager=True))
    told = puts.withColumn("_column", column)
    lone = told.join(repeated, "_column", "left_anti").drop("_column")
    return lone.unionByName(newest_versions(told.join(repeated, "_column", "left_semi").drop("_column"), versions))


#: a row's columns are dealt over so many tasks in a sweep
SWEEP_SPREAD = 8


def swept(cells: DataFrame, versions: int | None = 1, ts_range=None, spread: int = SWEEP_SPREAD,
          kinds=(DELETE_FAMILY, DELETE_COLUMN, DELETE_VERSION)) -> DataFrame:
    """Visible puts by one exchange, for tombstones of any size.

    Puts and tombstones go together to (row, family, share of the qualifier); a
    family tombstone goes to all ``spread`` shares, so a hot row is split.  There they
    lie in the order family tombstones, then by qualifier, newest first, tombstones
    before puts of their time.  One pass keeps the newest family tombstone, the newest
    column tombstone and the last version tombstone met so far, which decide each put;
    a second, in the same order, counts the versions that are left.  Of the tombstones
    only ``kinds`` are there; no pass is made for the others.
    """
    by_time = F.col("op") == F.lit(PUT)
    rows = cells.where(by_time.isNotNull())
    if ts_range is not None:  # a range filters puts only
        rows = rows.where(~by_time).unionByName(in_ts_range(rows.where(by_time), ts_range))
    is_family = F.col("op") == F.lit(DELETE_FAMILY)
    own = F.pmod(F.xxhash64("qualifier"), F.lit(spread)).cast("int")
    shares = F.when(is_family, F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(own))
    rows = rows.withColumn("_scope", F.when(is_family, 0).otherwise(1)).withColumn(
        "_put", by_time.cast("int")).withColumn("_share", F.explode(shares))
    group = ["row", "family", "_share"]
    column = [*group, "_scope", "qualifier"]
    newest = [F.col("ts").desc(), F.col("_put"), *_arrival_order(cells)]
    # all family tombstones of a group lie before its puts, so each put has met the newest of the group
    family = Window.partitionBy(*group).orderBy("_scope", "qualifier", *newest).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    met = Window.partitionBy(*column).orderBy(*newest).rowsBetween(Window.unboundedPreceding, 0)

    def time_of(op):
        return F.when(F.col("op") == F.lit(op), F.col("ts"))

    shown = F.col("_put") == 1
    if DELETE_FAMILY in kinds:
        rows = rows.withColumn("_fam", F.max(time_of(DELETE_FAMILY)).over(family))
        shown &= F.col("_fam").isNull() | (F.col("ts") > F.col("_fam"))
    if DELETE_COLUMN in kinds:
        rows = rows.withColumn("_col", F.max(time_of(DELETE_COLUMN)).over(met))
        shown &= F.col("_col").isNull() | (F.col("ts") > F.col("_col"))
    if DELETE_VERSION in kinds:
        rows = rows.withColumn("_ver", F.last(time_of(DELETE_VERSION), ignorenulls=True).over(met))
        shown &= F.col("_ver").isNull() | (F.col("ts") != F.col("_ver"))
    rows = rows.where(shown)
    # of a time the latest arrival; of a column the newest times
    order = Window.partitionBy(*column).orderBy(*newest)
    rows = rows.withColumn("_first", F.coalesce(F.lag("ts").over(order) != F.col("ts"), F.lit(True)))
    if versions is not None:
        count = order.rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("_nth", F.sum(F.col("_first").cast("int")).over(count)).where(
            F.col("_nth") <= int(versions)).drop("_nth")
    return rows.where("_first").drop("_first", "_scope", "_put", "_share", "_fam", "_col", "_ver")


def visible_puts(cells: DataFrame, ts_range=None, broadcast_bytes: int = BROADCAST_BYTES, known=None) -> DataFrame:
    """Puts that no tombstone hides: by broadcast tombstones as long as they fit, else
    by a sweep (which keeps one put per timestamp)."""
    known = known if known is not None else (cells, *measure_tombstones(cells))
    if known[1] and known[2] > broadcast_bytes:
        return swept(cells, None, ts_range, kinds=known[1])
    return apply_tombstones(cells, ts_range, known)


def visible_cells(cells: DataFrame, versions: int | None = 1, ts_range=None, keep_meta: bool = False,
                  broadcast_bytes: int = BROADCAST_BYTES, known=None, find_repeated: bool = False) -> DataFrame:
    """Visible cells ``row, family, qualifier, ts, value`` of a cell log.
    ``find_repeated``: columns with several puts are found first, only they are ranked."""
    known = known if known is not None else (cells, *measure_tombstones(cells))
    if known[1] and known[2] > broadcast_bytes:
        out = swept(cells, versions, ts_range, kinds=known[1])
    else:
        puts = apply_tombstones(cells, ts_range, known)
        out = newest_of_repeated(in_ts_range(cells, ts_range), puts, versions, broadcast_bytes) if find_repeated \
            else newest_versions(puts, versions)
    if keep_meta:
        return out
    return out.select("row", "family", "qualifier", "ts", "value")


def latest_value(cells: DataFrame) -> DataFrame:
    """Newest put per column, ignoring tombstones: a single partial+final
    aggregate (``max_by`` over the total arrival order)."""
    order = [F.col("ts")]
    if "load_id" in cells.columns:
        order.append(F.col("load_id"))
    order += [F.col(c) for c in ("seq", "pos") if c in cells.columns]
    best = F.max_by(F.struct("ts", "value"), F.struct(*order))
    return (
        cells.where(F.col("op") == F.lit(PUT))
        .groupBy(*KEY_Q)
        .agg(best.alias("_b"))
        .select(*KEY_Q, "_b.ts", "_b.value")
    )


def collapse_identical(cells: DataFrame, arrival=("seq",)) -> DataFrame:
    """Cells with the same full key collapse to one; the latest arrival --
    the largest ``arrival`` columns, compared in order -- supplies the value.
    One aggregate over the whole input, combined in the map tasks first."""
    keys = ["row", "family", "qualifier", "ts", "op"]
    kept = [c for c in arrival if c not in ("value", *keys)]
    order = F.struct(*arrival)
    last = cells.groupBy(*keys).agg(F.max_by(F.struct("value", *kept), order).alias("_last"))
    return last.select(*keys, "_last.*")
