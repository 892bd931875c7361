"""Split keys taken from the data, for keys of any form.

A mergeable quantile sketch over binary keys: level i holds keys that stand for
2 ** i rows each; a level that is full is sorted and every other key goes up one
level.  Each input partition makes one sketch, sketches of ``FAN_IN`` partitions
merge into one, and so on; a sketch is at most ``SIZE`` keys a level, so neither a
task nor the driver holds more than ``FAN_IN`` sketches, however many rows there
are.  A place is off by about log2(rows / SIZE) / (2 * SIZE) of the rows at most.
"""

from __future__ import annotations

import math
import random

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

SIZE, FAN_IN = 1024, 64
_SCHEMA = "id long, level int, keys array<binary>"


class Sketch:
    def __init__(self, size: int = SIZE, seed: int = 0):
        self.size, self.levels, self.random = size, [[]], random.Random(seed)

    def add(self, keys: list[bytes], level: int = 0):
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level] += keys
        while level < len(self.levels) and len(self.levels[level]) >= 2 * self.size:
            full = sorted(self.levels[level])
            odd = [full.pop()] if len(full) % 2 else []  # an odd one out stays
            self.levels[level] = odd
            if level + 1 == len(self.levels):
                self.levels.append([])
            level += 1
            self.levels[level] += full[self.random.randrange(2)::2]

    def quantiles(self, n: int) -> list[bytes]:
        """The keys that cut the rows into ``n`` even parts (fewer if keys repeat)."""
        weighted = sorted((k, 1 << i) for i, keys in enumerate(self.levels) for k in keys)
        total, upto, out = sum(w for _, w in weighted), 0, []
        for k, w in weighted:
            while len(out) < n - 1 and upto + w > (len(out) + 1) * total / n:
                out.append(k)
            upto += w
        return sorted(set(out) - {b""})


def _rows(sketch: Sketch, key: int) -> pa.Table:
    levels = [(i, ks) for i, ks in enumerate(sketch.levels) if ks]
    return pa.table({"id": pa.array([key] * len(levels), pa.int64()), "level": pa.array([i for i, _ in levels], pa.int32()),
                     "keys": pa.array([ks for _, ks in levels], pa.list_(pa.binary()))})


def key_sketch(df: DataFrame, key: str) -> Sketch:
    """The sketch of a binary or text column (null keys are left out)."""
    ship_package(df.sparkSession)
    keys = df.select(F.col(key).cast("binary").alias("k")).where(F.col("k").isNotNull())
    keys = keys.select(F.spark_partition_id().cast("long").alias("id"), "k")

    def first(batches):
        one, at = None, 0
        for b in batches:
            if b.num_rows:
                at = b.column(0)[0].as_py()
                one = one or Sketch(seed=at)
                one.add(b.column(1).to_pylist())
        if one is not None:
            yield from _rows(one, at).to_batches()

    def merge(table: pa.Table) -> pa.Table:
        group = table.column("id")[0].as_py() // FAN_IN
        one = Sketch(seed=group)
        for level, ks in zip(table.column("level").to_pylist(), table.column("keys").to_pylist()):
            one.add(ks, level)
        return _rows(one, group)

    made = keys.mapInArrow(first, _SCHEMA)
    for _ in range(max(1, math.ceil(math.log(max(2, keys.rdd.getNumPartitions()), FAN_IN)))):
        made = made.groupBy(F.floor(F.col("id") / FAN_IN).alias("group")).applyInArrow(merge, _SCHEMA)
    out = Sketch()
    for r in made.collect():  # FAN_IN sketches at most
        out.add([bytes(k) for k in r["keys"]], r["level"])
    return out


def data_splits(df: DataFrame, key: str, n_regions: int) -> list[bytes]:
    """Split keys for ``n_regions`` regions of about equal rows of ``df``."""
    return key_sketch(df, key).quantiles(n_regions)
