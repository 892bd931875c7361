"""Grouping and counting over cells.

All of these are hash aggregates with a partial (map-side) step, so a hot
key is combined before the shuffle; none collects a group into a list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.regions import as_bytes
from ..sources.table import CellTable, known_tombstones, read_cells
from .visibility import visible_puts


def count_rows(df: DataFrame) -> DataFrame:
    """A3: global count; one row, 0 on empty input."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def count_per_element(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """A2: ``Count.perElement`` -> (element, n)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def table_row_count(table: CellTable, families=None) -> DataFrame:
    """A4: number of rows with at least one visible cell: tombstones applied,
    versions not ranked, distinct rows counted."""
    cells = read_cells(table, families=families)
    seen = visible_puts(cells, known=known_tombstones(table, cells, families))
    return seen.select("row").distinct().agg(F.count(F.lit(1)).alias("n_rows"))


def cell_presence_count(visible: DataFrame, expected) -> DataFrame:
    """A5: for each expected ``(family, qualifier)``, how many rows hold it."""
    conds = None
    for f, q in expected:
        c = (F.col("family") == F.lit(f)) & (F.col("qualifier") == F.lit(bytearray(as_bytes(q))))
        conds = c if conds is None else (conds | c)
    return (
        visible.where(conds)
        .groupBy("family", F.decode("qualifier", "UTF-8").alias("qualifier"))
        .agg(F.count(F.lit(1)).alias("n_present"))
    )


def wide_rows(visible: DataFrame, columns) -> DataFrame:
    """one row per row key with one column per known ``(family,
    qualifier[, alias])``; absent cells are null (``Result.getValue``).
    A pivot over a fixed column list: bounded width, partial aggregation."""
    picks = []
    for c in columns:
        f, q = c[0], c[1]
        alias = c[2] if len(c) > 2 else f"{f}:{q}"
        m = (F.col("family") == F.lit(f)) & (F.col("qualifier") == F.lit(bytearray(as_bytes(q))))
        picks.append(F.max(F.when(m, F.col("value"))).alias(alias))
    return visible.groupBy("row").agg(*picks)
