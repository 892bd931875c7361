"""cellhouse: bulk operations on wide-cell tables, built on Spark DataFrames.

A table is a row-range-partitioned, append-only parquet log of cells
``(row, family, qualifier, ts, op, value, seq)``.  Puts, deletes and bulk
loads all append; reads resolve the newest visible version.
"""

from .model import DELETE_COLUMN, DELETE_FAMILY, DELETE_VERSION, PUT
from .session import build_session, new_path, work_root
from .sources.table import CellTable, create_table, open_table, read_cells, read_table

__all__ = [
    "PUT", "DELETE_VERSION", "DELETE_COLUMN", "DELETE_FAMILY",
    "build_session", "new_path", "work_root",
    "CellTable", "create_table", "open_table", "read_cells", "read_table",
]
