"""Batched point lookups as joins.

The request side is reduced to its distinct keys and measured by one
action (count, bytes, min, max).  The table is cut to the key range (a
region partition filter and row filters that reach parquet) and, when the key set fits
``BROADCAST_BYTES``, semi-joined against a broadcast of the keys before
any shuffle -- only requested rows reach visibility resolution.  Beyond
that bound the distinct keys are written once; a hash filter of them (bitmaps
built by the executors, measured, then broadcast) and the regions they lie in cut
the table before the semi join shuffles (AQE splits skewed partitions).  The
final request-to-result join keeps every request with a key, duplicates
included, and yields nulls for absent rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.regions import as_bytes, region_index, regions_for_range
from ..model import BROADCAST_BYTES, DELETE_FAMILY, RESULT_CELL
from ..session import new_path
from ..sources.table import CellTable, known_tombstones, read_cells, resolve
from .visibility import visible_puts


def _key_col(requests: DataFrame, row: str) -> F.Column:
    t = requests.schema[row].dataType
    c = F.col(row)
    return c if isinstance(t, T.BinaryType) else F.encode(c.cast("string"), "UTF-8")


def _present(requests: DataFrame, row: str) -> DataFrame:
    """Requests with their key as ``_key``; a null key asks for nothing and goes."""
    return requests.withColumn("_key", _key_col(requests, row)).where(F.col("_key").isNotNull())


#: bits of the hash filter per key: one row in eight or sixteen passes by chance
FILTER_BITS = (16, 8)
BITMAP_BITS = 1 << 15


def _hash_bit(key: F.Column, bits: int) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_filter(keys: DataFrame, n: int, filter_bytes: int) -> tuple[DataFrame, int] | None:
    """Bitmaps ``_bucket, _bitmap`` of the hashes of ``keys.row`` and the number of bits;
    None where even ``FILTER_BITS[-1]`` bits a key would exceed ``filter_bytes``."""
    for each in FILTER_BITS:
        bits = -(-n * each // BITMAP_BITS) * BITMAP_BITS
        if bits // 8 <= filter_bytes:
            bit = _hash_bit(F.col("row"), bits)
            return keys.groupBy(F.bitmap_bucket_number(bit).alias("_bucket")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bitmap")), bits
    return None


def maybe_requested(cells: DataFrame, keys: DataFrame, n: int, filter_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``cells`` without most of those whose row is not among the ``n`` ``keys``."""
    made = key_filter(keys, n, filter_bytes)
    if made is None:
        return cells
    bitmaps, bits = made
    bit = _hash_bit(F.col("row"), bits)
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substr("_bitmap", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    near = cells.withColumn("_bucket", F.bitmap_bucket_number(bit)).join(F.broadcast(bitmaps), "_bucket")
    return near.where(F.getbit(byte, (place % 8).cast("int")) == 1).drop("_bucket", "_bitmap")


def requested_cells(requests: DataFrame, table: CellTable, row: str = "row", families=None, qualifiers=None,
                    pairs=None, broadcast_bytes: int = BROADCAST_BYTES, filter_bytes: int = BROADCAST_BYTES):
    """The log of the requested rows only, and its region range.  ``pairs``
    keeps exactly those (family, qualifier) columns and all family tombstones."""
    keys = requests.select(_key_col(requests, row).alias("row")).where(F.col("row").isNotNull()).distinct()
    st = keys.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length("row") + F.lit(64)), F.lit(0)).alias("b"),
        F.min("row").alias("lo"),
        F.max("row").alias("hi"),
    ).first()
    if st["n"] == 0:
        return read_cells(table, families=families, qualifiers=qualifiers).where(F.lit(False)), None
    lo, stop = bytes(st["lo"]), bytes(st["hi"]) + b"\0"
    cells = read_cells(table, lo, stop, families, qualifiers, with_region=st["b"] > broadcast_bytes)
    if pairs is not None:
        wanted = F.col("op") == F.lit(DELETE_FAMILY)
        for f, q in pairs:
            wanted = wanted | ((F.col("family") == F.lit(f)) & (F.col("qualifier") == F.lit(bytearray(as_bytes(q)))))
        cells = cells.where(wanted)
    regions = regions_for_range(table.starts, lo, stop)
    if st["b"] <= broadcast_bytes:
        return cells.join(F.broadcast(keys), "row", "left_semi"), regions
    path = new_path(table.spark, "keys")
    keys.write.parquet(path)  # read by the filter, the regions and the join
    keys = table.spark.read.schema("row binary").parquet(path)
    at = keys.select(region_index("row", table.starts, presorted=True).alias("r")).distinct().collect()  # by region
    cells = cells.where(F.col("region").isin([r["r"] for r in at])).drop("region")
    return maybe_requested(cells, keys, st["n"], filter_bytes).join(keys, "row", "left_semi"), regions


def requested_visible(requests: DataFrame, table: CellTable, row: str = "row", families=None, qualifiers=None,
                      versions: int | None = 1, ts_range=None, pairs=None, broadcast_bytes: int = BROADCAST_BYTES,
                      filter_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Visible cells of the requested rows (long form)."""
    cells, regions = requested_cells(requests, table, row, families, qualifiers, pairs, broadcast_bytes, filter_bytes)
    return resolve(table, cells, versions, ts_range, families, regions)


def bulk_get(requests: DataFrame, table: CellTable, columns, row: str = "row", ts_range=None,
             event_time=None, broadcast_bytes: int = BROADCAST_BYTES, filter_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One output row per request with a key (duplicates kept, order not).

    ``columns`` is a list of ``(family, qualifier)`` or
    ``(family, qualifier, alias)``; each becomes a BINARY column with the
    newest value (null when the cell is absent).  ``found`` tells whether any
    of exactly these columns is visible (an empty restricted Get is "not
    found").  ``event_time`` (W1): a column copied to ``event_ts``.  Keys of up to
    ``broadcast_bytes`` are broadcast; of more, a hash filter of at most ``filter_bytes``.
    """
    cols = [(c[0], c[1], c[2] if len(c) > 2 else f"{c[0]}:{c[1]}") for c in columns]
    fams = sorted({f for f, _, _ in cols})
    quals = sorted({q for _, q, _ in cols})
    cells = requested_visible(requests, table, row, fams, quals, 1, ts_range, [(f, q) for f, q, _ in cols],
                              broadcast_bytes, filter_bytes)
    picks = [
        F.max(F.when((F.col("family") == F.lit(f)) & (F.col("qualifier") == F.lit(bytearray(as_bytes(q)))),
                     F.col("value"))).alias(a)
        for f, q, a in cols
    ]
    wide = cells.groupBy("row").agg(*picks, F.lit(True).alias("found"))
    req = _present(requests, row)
    if event_time is not None:
        req = req.withColumn("event_ts", event_time)
    out = req.join(wide.withColumnRenamed("row", "_key"), "_key", "left")
    return out.withColumn("found", F.coalesce(F.col("found"), F.lit(False))).drop("_key")


def bulk_get_rows(requests: DataFrame, table: CellTable, row: str = "row", families=None, qualifiers=None,
                  versions: int | None = 1, ts_range=None) -> DataFrame:
    """J1, row-shaped: one output row per request with ``cells``, the array of
    the row's visible cells in cell order (family, qualifier, newest first);
    empty for an absent row.  A row is the unit of a lookup, so its cells are
    one value, as in a Get."""
    cells = requested_visible(requests, table, row, families, qualifiers, versions, ts_range)
    cell = F.struct("family", "qualifier", (-F.col("ts")).alias("ts"), "value")
    rows = cells.groupBy(F.col("row").alias("_key")).agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    rows = rows.withColumn("cells", F.transform("cells", lambda c: F.struct(
        c["family"].alias("family"), c["qualifier"].alias("qualifier"), (-c["ts"]).alias("ts"), c["value"].alias("value"))))
    out = _present(requests, row).join(rows, "_key", "left").drop("_key")
    return out.withColumn("cells", F.coalesce("cells", F.array().cast(T.ArrayType(RESULT_CELL))))


def bulk_get_cells(requests: DataFrame, table: CellTable, row: str = "row", families=None, qualifiers=None,
                   versions: int | None = 1, ts_range=None) -> DataFrame:
    """J1/J4 long form: one row per (request, visible cell); a request with
    no cell keeps one row with null cell columns."""
    cells = requested_visible(requests, table, row, families, qualifiers, versions, ts_range)
    return _present(requests, row).join(cells.withColumnRenamed("row", "_key"), "_key", "left").drop("_key")


def _rows_there(requests: DataFrame, table: CellTable, row: str, families) -> DataFrame:
    """Requested rows with a visible cell: tombstones applied, no ranking."""
    cells, regions = requested_cells(requests, table, row, families)
    seen = visible_puts(cells, known=known_tombstones(table, cells, families, regions))
    return seen.select(F.col("row").alias("_key")).distinct()


def bulk_get_exists(requests: DataFrame, table: CellTable, row: str = "row", families=None) -> DataFrame:
    """Requests whose row exists (duplicates kept)."""
    return _present(requests, row).join(_rows_there(requests, table, row, families), "_key", "left_semi").drop("_key")


def bulk_get_missing(requests: DataFrame, table: CellTable, row: str = "row", families=None) -> DataFrame:
    """Requests whose row is absent (duplicates kept)."""
    return _present(requests, row).join(_rows_there(requests, table, row, families), "_key", "left_anti").drop("_key")
