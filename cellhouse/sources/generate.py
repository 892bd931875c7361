"""S3: synthetic cell lines, generated by Spark from an index column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import DEFAULT_SPLIT_KEYS

# --- fixed values -----------------------------------------------------------
# Defaults of the example job's generator: families and rows per split key.
DEFAULT_FAMILIES = ("fam0", "fam1", "fam2")
DEFAULT_ROWS = 5
# Line shape: "{split}{i} {family} qualifier v[{i}]"
# ---------------------------------------------------------------------------


def gen_lines(index: DataFrame, index_col: str = "i", split_keys=DEFAULT_SPLIT_KEYS,
              families=DEFAULT_FAMILIES) -> DataFrame:
    """For every index value, split key and family, one line
    ``"{split}{i} {family} qualifier v[{i}]"``.  Split keys and families are
    small fixed lists, expanded with ``explode`` (no join)."""
    i = F.col(index_col).cast("string")
    return (
        index.select(i.alias("_i"))
        .withColumn("_split", F.explode(F.array(*[F.lit(s) for s in split_keys])))
        .withColumn("_family", F.explode(F.array(*[F.lit(f) for f in families])))
        .select(F.format_string("%s%s %s qualifier v[%s]", "_split", "_i", "_family", "_i").alias("line"))
    )


def gen_cells(spark: SparkSession, n: int = DEFAULT_ROWS, split_keys=DEFAULT_SPLIT_KEYS,
              families=DEFAULT_FAMILIES) -> DataFrame:
    """The example job's generator: indexes ``0..n-1`` from ``spark.range``."""
    return gen_lines(spark.range(n).withColumnRenamed("id", "i"), "i", split_keys, families)
