"""Connected components of an edge table by alternating large-star and
small-star steps: each step hangs every node on the least node it knows of, so
components become stars in a few rounds.  Rounds are written to the shared
folder; nothing but a count and a checksum reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``u, v`` (any orientation, repeats and loops allowed) -> ``u, v`` with
    ``v`` the least node of the component of ``u``, for each ``u`` that is not
    itself the least node of its component."""
    u, v = F.col("u"), F.col("v")
    e = stored(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct(), "edges")
    state = _state(e)
    while state[0]:
        both = e.union(e.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("k")).select(v.alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        key = least.select(F.col("u").alias("k"), "m")
        small = large.join(key, F.col("u") == F.col("k")).where("v <> m").select(v.alias("u"), F.col("m").alias("v"))
        e = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        before, state = state, _state(e)
        if state == before:
            break
    return e
