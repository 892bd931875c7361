"""Helpers shared by the training-data operators.

Text is handled as whole Arrow string columns: a batch is cut into blocks of
bounded bytes, a block is one flat ``uint8`` array, and words, hashes and
windows are numpy arrays over it.  Memory per task is a small multiple of the
block size (a single text longer than the block is a block of its own).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path, ship_package

BLOCK_BYTES = 2 << 20
HASH_SEGMENT = 1 << 20

_rng = np.random.default_rng(20240229)
_BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

WHITESPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` below the shared work folder and read it back: cuts the
    lineage in files that every executor can reach, so a lost executor never
    loses the result."""
    spark = df.sparkSession
    path = new_path(spark, f"llm-{name}")
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROWS_PER_BATCH = "1000"


def prepare(spark: SparkSession) -> None:
    """Make this package importable in Python workers, and keep the Arrow
    batches of whole texts small (Spark's 10,000 rows would be tens of MB on
    both sides of every task)."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)


def hash_share(key: Column, n: int, total: int) -> Column:
    """About ``n`` of ``total`` rows, chosen by hash: no sort, no shuffle."""
    return F.pmod(key, F.lit(1 << 40)) < F.lit(min(1 << 40, -(-n * (1 << 40) // max(1, total))))


def free_name(columns: list[str], stem: str) -> str:
    """A column name that clashes with none of ``columns`` (case-insensitively)."""
    taken = {c.lower() for c in columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{stem}_{uuid.uuid4().hex[:8]}"
    return name


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id's decimal text has remainder 1 modulo 3 (null: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


# ---------------------------------------------------------------- text blocks


def blocks(arr: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Cut a string column into runs of at most ``limit`` bytes: (first row, run).
    A longer single text is a run of its own.  Nulls become empty texts."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string()).fill_null("")
    ends = np.cumsum(pc.binary_length(arr).to_numpy(zero_copy_only=False).astype(np.int64))
    i, n, base = 0, len(arr), 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield i, arr.slice(i, j - i)
        i, base = j, int(ends[j - 1])


def flat(run: pa.Array, end: str = " ") -> tuple[np.ndarray, np.ndarray]:
    """The run's texts, each followed by ``end``, as one byte array, and the
    offset at which each text begins (one more entry than texts)."""
    joined = pc.binary_join_element_wise(run, pa.scalar("", run.type), pa.scalar(end, run.type))
    _, offsets, data = joined.buffers()
    off = np.frombuffer(offsets, np.int64)[joined.offset: joined.offset + len(joined) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def byte_class(separators: bytes) -> np.ndarray:
    cls = np.ones(256, np.uint8)
    cls[list(separators)] = 0
    return cls


def spans(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ones."""
    edge = np.flatnonzero(np.diff(is_word, prepend=np.uint8(0), append=np.uint8(0)))
    return edge[::2], edge[1::2]


_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        for k, r in enumerate((_R, _R_INV)):
            p = np.full(n, r, np.uint64)
            p[0] = 1
            _POW[k] = np.multiply.accumulate(p)
    return _POW[0], _POW[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche a 64-bit value."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each span (spans ascending, not
    overlapping): a polynomial over random byte values, read off prefix sums.
    ``fold_case`` takes A-Z as a-z."""
    values = _BYTE_VALUES
    if fold_case:
        values = values.copy()
        values[65:91] = values[97:123]
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASH_SEGMENT, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        up, down = _powers(max(b - a, HASH_SEGMENT))
        total = np.empty(b - a + 1, np.uint64)
        total[0] = 0
        np.cumsum(values[data[a:b]] * up[: b - a], out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        # s < b - a always holds, or the span is empty at the very end
        out[i:j] = (total[e] - total[s]) * down[np.minimum(s, len(down) - 1)] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive values: ``len(h) - k + 1`` of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out *= _R
        out += h[j: j + n]
    return mix(out)


def window_hashes_at(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """``window_hashes(h, k)`` at the places ``at`` only."""
    out = h[at]
    for j in range(1, k):
        out *= _R
        out += h[at + j]
    return mix(out)


def covered(first: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in ``[i, i + width)`` for an ``i`` in ``first``."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, first, 1)
    np.add.at(d, np.minimum(first + width, n), -1)
    return np.cumsum(d[:-1]) > 0


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive ``bounds``."""
    c = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return c[bounds[1:]] - c[bounds[:-1]]
