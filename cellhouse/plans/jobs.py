"""The end-to-end load job -- text lines (or generated lines) -> cell
parser -> bulk load -> clean-up of staging."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.bytes import now_millis
from ..functions.text import parse_cells
from ..model import DEFAULT_SPLIT_KEYS
from ..operators.load import bulk_load
from ..operators.maintain import vacuum
from ..session import new_path
from ..sources.generate import DEFAULT_FAMILIES, DEFAULT_ROWS, gen_cells
from ..sources.table import create_table
from ..sources.text import read_lines


def load_text_job(spark: SparkSession, table_path: str, input_path: str | None = None, n: int = DEFAULT_ROWS,
                  families=DEFAULT_FAMILIES, split_keys=DEFAULT_SPLIT_KEYS, cell_fn=None, ts=None,
                  exclude_from_minor: bool = False):
    """Create the table if needed, read ``input_path`` as lines (or generate
    ``n`` rows per split key and family), turn each line into a cell with
    ``cell_fn(line_col, ts_col)`` (default: the 4-token parser), bulk load
    through a fresh staging folder, then remove leftovers."""
    table = create_table(spark, table_path, families, split_keys)
    lines = read_lines(spark, input_path) if input_path else gen_cells(spark, n, split_keys, families)
    ts_c = F.lit(ts).cast("bigint") if ts is not None else now_millis()
    fn = cell_fn or parse_cells
    cells = lines.select(fn(F.col("line"), ts_c).alias("c")).where(F.col("c").isNotNull()).select("c.*")
    bulk_load(table, cells, staging=new_path(spark, "job-staging"), exclude_from_minor=exclude_from_minor)
    vacuum(table)
    return table
