"""Cell data model: schemas, operation codes and limits.

A table is an append-only log of cells ``(row, family, qualifier, ts, op,
value, seq, pos)``.  Puts and tombstones share that shape; what a reader sees is
resolved on read (see ``cellhouse.operators.visibility``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Operation codes.  A larger code sorts first at equal timestamp, so a
# tombstone is met before the put it masks when cells are read in key order.
PUT = 4
DELETE_VERSION = 8
DELETE_COLUMN = 12
DELETE_FAMILY = 14
VALID_OPS = (PUT, DELETE_VERSION, DELETE_COLUMN, DELETE_FAMILY)

# Rolling threshold for one written file (bytes), and the number of files a
# (family, region) may hold before a minor compaction merges them.
DEFAULT_FILE_BYTES = 128 * 1024 * 1024
DEFAULT_MAX_FILES = 32
# Default split keys of the example table.
DEFAULT_SPLIT_KEYS = ("aaa", "bbb")
# ---------------------------------------------------------------------------

# Largest key/tombstone set (in bytes) that is ever broadcast.  Every
# broadcast in this package is preceded by an action that measures the side.
BROADCAST_BYTES = 64 * 1024 * 1024
# Up to so many bytes of cell files a read ranks all cells; beyond it, only
# those of columns that an action found to hold several puts.
RANKED_BYTES = 16 * 1024 * 1024
# Region-index expressions are a balanced tree of comparisons up to this many
# start keys; beyond it a binary search over one array literal.
TREE_REGION_LIMIT = 512

CELL_SCHEMA = T.StructType(
    [
        T.StructField("row", T.BinaryType(), False),
        T.StructField("family", T.StringType(), False),
        T.StructField("qualifier", T.BinaryType(), False),
        T.StructField("ts", T.LongType(), False),
        T.StructField("op", T.ByteType(), False),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("seq", T.LongType(), False),
        # place inside the element that carried the cell (thin rows), else 0
        T.StructField("pos", T.IntegerType(), False),
    ]
)
CELL_COLUMNS = [f.name for f in CELL_SCHEMA.fields]

# Columns physically inside the data files; load_id, family and region are
# directory partitions.  ``src_load`` is set only by compaction: the load a
# cell first arrived in, so arrival order survives a rewrite.
FILE_SCHEMA = T.StructType(
    [f for f in CELL_SCHEMA.fields if f.name != "family"]
    + [T.StructField("src_load", T.StringType(), True)]
)
STORED_SCHEMA = T.StructType(
    list(FILE_SCHEMA.fields)
    + [
        T.StructField("load_id", T.StringType(), False),
        T.StructField("family", T.StringType(), False),
        T.StructField("region", T.IntegerType(), False),
    ]
)

META_SCHEMA = T.StructType(
    [
        T.StructField("families", T.ArrayType(T.StringType(), False), False),
        T.StructField("region_starts", T.ArrayType(T.BinaryType(), False), False),
        T.StructField("family_options", T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())), True),
    ]
)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("family", T.StringType(), False),
        T.StructField("region", T.IntegerType(), False),
        T.StructField("n_cells", T.LongType(), False),
        T.StructField("min_row", T.BinaryType(), True),
        T.StructField("max_row", T.BinaryType(), True),
        T.StructField("min_ts", T.LongType(), True),
        T.StructField("max_ts", T.LongType(), True),
        T.StructField("n_files", T.LongType(), False),
        T.StructField("n_small_files", T.LongType(), False),  # under half the file target
        T.StructField("n_bytes", T.LongType(), False),
        # tombstones by kind, and the bytes of all tombstone keys
        T.StructField("n_family_del", T.LongType(), False),
        T.StructField("n_column_del", T.LongType(), False),
        T.StructField("n_version_del", T.LongType(), False),
        T.StructField("del_bytes", T.LongType(), False),
        T.StructField("load_time", T.LongType(), False),
        T.StructField("exclude_from_minor", T.BooleanType(), False),
        T.StructField("kind", T.StringType(), False),
        # "load_id/family/region" triples this entry replaces (compaction).
        T.StructField("replaces", T.ArrayType(T.StringType(), False), False),
        # major compaction only: versions kept per column (null = all)
        T.StructField("versions_kept", T.IntegerType(), True),
        T.StructField("load_id", T.StringType(), False),
    ]
)

RESULT_CELL = T.StructType(
    [
        T.StructField("family", T.StringType(), False),
        T.StructField("qualifier", T.BinaryType(), False),
        T.StructField("ts", T.LongType(), False),
        T.StructField("value", T.BinaryType(), True),
    ]
)
