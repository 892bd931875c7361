"""Sorted layout checks and the ordered scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.regions import region_index
from ..session import work_root
from ..sources.table import CellTable


def ordered_rank(df: DataFrame, *keys: str, rank_col: str = "rank") -> DataFrame:
    """1-based position of each row in ``keys`` order, distributed.

    Range exchange + in-task sort, checkpointed (lineage cut in the shared
    checkpoint folder) so both passes see the same partitions; one small
    job counts rows per partition, prefix offsets (one number per partition)
    are broadcast, and rank = offset + position inside the partition.  No
    single-partition window.
    """
    spark = df.sparkSession
    work_root(spark)  # make sure a checkpoint folder is set
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = ordered.withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    ordered = ordered.checkpoint(eager=True)
    counts = sorted((r["_p"], r["n"]) for r in ordered.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect())
    off, acc = [], 0
    for p, n in counts:
        off.append((p, acc))
        acc += n
    offsets = spark.createDataFrame(off, T.StructType([T.StructField("_p", T.IntegerType()),
                                                         T.StructField("_off", T.LongType())]))
    in_part = F.col("_m") - F.shiftleft(F.col("_p").cast("bigint"), 33)
    return (
        ordered.join(F.broadcast(offsets), "_p")
        .withColumn(rank_col, F.col("_off") + in_part + F.lit(1))
        .drop("_p", "_m", "_off")
    )


def rows_in_order(cells: DataFrame, starts, rank_col: str = "rank") -> DataFrame:
    """O4 from the regions' order: ``row`` and its 1-based place among all distinct
    rows.  Regions ascend, so a row's rank is the number of rows in the regions before
    its own plus its place there: one exchange by region, which both the counts and
    the places read; nothing is sampled or written.  The counts are a row per region."""
    at = cells.select("row", region_index(F.col("row"), starts, presorted=True).alias("_region")).repartition(
        "_region").dropDuplicates(["_region", "row"])
    before = Window.orderBy("_region").rowsBetween(Window.unboundedPreceding, -1)
    counts = at.groupBy("_region").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select("_region", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.row_number().over(Window.partitionBy("_region").orderBy("row"))
    return at.withColumn("_place", place).join(F.broadcast(counts), "_region").select(
        "row", (F.col("_off") + F.col("_place")).alias(rank_col))


def file_order_violations(table: CellTable) -> DataFrame:
    """O1 check: per (family, region), cells and how many of them break the
    cell order (row up, qualifier up, ts down) against the cell before them
    in the same file, by physical position (``_metadata.row_index``)."""
    df = table.stored().select(
        "family", "region", "row", "qualifier", "ts",
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_pos"),
    )
    w = Window.partitionBy("_file").orderBy("_pos")
    pr, pq, pt = F.lag("row").over(w), F.lag("qualifier").over(w), F.lag("ts").over(w)
    bad = (pr > F.col("row")) | ((pr == F.col("row")) & (pq > F.col("qualifier"))) | (
        (pr == F.col("row")) & (pq == F.col("qualifier")) & (pt < F.col("ts"))
    )
    return (
        df.withColumn("_bad", F.coalesce(bad, F.lit(False)).cast("int"))
        .groupBy("family", "region")
        .agg(F.count(F.lit(1)).alias("n_cells"), F.sum("_bad").cast("bigint").alias("n_unsorted"))
    )
