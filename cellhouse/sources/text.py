"""S1 text line source, S2 in-memory source, S4 text sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``line`` per text line (``\\n``, ``\\r\\n`` or ``\\r``)."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    """S1, streaming: new files under ``path`` become new lines."""
    return spark.readStream.text(path).withColumnRenamed("value", "line")


def literal_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """A small driver-side collection as a DataFrame (tests, fixtures)."""
    return spark.createDataFrame(rows, schema)


def write_lines(df: DataFrame, path: str, num_shards: int | None = None, column: str | None = None) -> str:
    """Write one string column as text files.

    ``num_shards`` fixes the number of output files with a shuffle
    (``repartition``), so the upstream keeps its parallelism; file names
    are Spark's own ``part-*``.  Fails if ``path`` exists.
    """
    col = column or df.columns[0]
    out = df.select(F.col(col).cast(T.StringType()).alias("value"))
    if num_shards:
        out = out.repartition(int(num_shards))
    out.write.mode("errorifexists").text(path)
    return path
