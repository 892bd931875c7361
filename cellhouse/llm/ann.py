"""Approximate nearest neighbours by randomly rotated one-bit codes.

Index: every vector x, less a centre c, is turned by a random rotation and kept
as the signs of its coordinates (packed bits) with two correction scalars: its
length |x - c|, and a = <o, s>, the inner product of its direction o with the
direction s of its sign vector.  For a query q,

    <q, x> = <q, c> + |x - c| <q, o>,     <q, o> ~ <q, s> / a

where <q, s> is read off the bits: the turned query is rounded to ``PLANES`` bits
a coordinate, and each of its bit planes meets the code as AND and popcount.  The
estimate's error is below  EPSILON |q| sqrt(1 / a^2 - 1) / sqrt(d - 1)  but for a
chance that falls like a normal tail in EPSILON.

Search: in a block of candidates the best ``HEAD * k`` by estimate are scored;
their k-th score, or the k-th of the blocks before if that is better, is the bar,
and each candidate whose estimate plus error bound reaches the bar is reranked by
its exact inner product on the original vectors.

Plan: candidates and queries are dealt by hash into blocks of bounded rows; a
group is one block of each (each candidate travels once per query block, each
query once per candidate block).  Candidates come in rounds, the first of
``BLOCK`` rows, each ``GROWTH`` times the ones before: a round begins with the bars
of those before it, so a query brings back about ``k * GROWTH`` rows a round
however many blocks there are.  Only row counts and one centre pass the driver.

The centre is the mean of at most ``BLOCK`` rows chosen by hash (any centre gives
right estimates); everything else covers all rows.  Memory of a task: a block of
each side and one tile of estimates.  Every query meets every candidate's code,
so the work is queries times candidates, at a few operations a pair.

Defined results: a query is a row whose id is divisible by ``every``; vectors
null, empty, zero or with null or non-finite components take no part; null ids
take no part; a repeated row is another row (its copy is a candidate of it, and a
query of its own); ties go to the smaller id; vectors of different lengths do not
meet; fewer than ``k`` candidates give fewer rows; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored

K, EVERY = 20, 20
EPSILON, PLANES = 3.0, 4
BLOCK, QUERY_BLOCK, GROWTH = 8192, 16384, 4
HEAD = 4
TILE = 1 << 18
SEED = 42

_ROTATIONS: dict[int, np.ndarray] = {}


def rotation(d: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every worker."""
    if d not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng([SEED, d]).standard_normal((d, d)))
        _ROTATIONS.clear()
        _ROTATIONS[d] = q * np.sign(np.diag(r))
    return _ROTATIONS[d]


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    out = np.zeros((len(bits), -(-bits.shape[1] // 64) * 8), np.uint8)
    out[:, : -(-bits.shape[1] // 8)] = np.packbits(bits, 1, bitorder="little")
    return out.view("<u8")


class Codes:
    """One-bit codes and correction scalars of the rows of ``x``."""

    def __init__(self, x: np.ndarray, centre: np.ndarray):
        self.d = x.shape[1]
        turned = (x - centre) @ rotation(self.d)
        self.length = np.sqrt((turned * turned).sum(1))
        self.words = packed(turned > 0)
        whole = np.maximum(self.length * math.sqrt(self.d), 1e-300)
        self.a = np.where(self.length > 0, np.abs(turned).sum(1) / whole, 1.0)


def estimates(q: np.ndarray, centre: np.ndarray, words: np.ndarray, length: np.ndarray, a: np.ndarray,
              epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries by codes) and their error bounds."""
    d = q.shape[1]
    turned = q @ rotation(d)
    low = turned.min(1)
    step = np.maximum((turned.max(1) - low) / ((1 << PLANES) - 1), 1e-300)
    level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
    rounded = level * step[:, None] + low[:, None]
    off = np.sqrt(((turned - rounded) ** 2).sum(1))
    total = np.zeros((len(q), len(words)), np.int32)
    for p in range(PLANES):
        plane = packed((level >> p & 1).astype(np.uint8))
        for w in range(words.shape[1]):
            total += np.bitwise_count(plane[:, w, None] & words[None, :, w]).astype(np.int32) << p
    ones = np.bitwise_count(words).sum(1)
    on = step[:, None] * total + low[:, None] * ones  # the rounded query's coordinates where the bit is set
    scale = length / a
    value = (2 * on - rounded.sum(1)[:, None]) / math.sqrt(d) * scale + (q @ centre)[:, None]
    spread = length * np.sqrt(np.maximum(1 / (a * a) - 1, 0)) / math.sqrt(max(1, d - 1))
    size = np.sqrt((q * q).sum(1))
    return value, epsilon * (size[:, None] * spread + off[:, None] / math.sqrt(d) * scale)


def exact(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (q[i], x[j]), components added in order."""
    out = np.zeros(len(i))
    for c in range(q.shape[1]):
        out += q[i, c] * x[j, c]
    return out


def best_of_block(q: np.ndarray, q_row: np.ndarray, bar: np.ndarray, x: np.ndarray, x_row: np.ndarray,
                  x_id: np.ndarray, codes: tuple, centre: np.ndarray, k: int, epsilon: float = EPSILON):
    """(query, candidate, score): for each query at most ``k`` pairs that reach
    its bar (give or take ``slack``), none with the row itself."""
    n = len(x)
    tile = max(1, TILE // n)
    slack = 1e-12 * x.shape[1] * np.sqrt((q * q).sum(1) * (x * x).sum(1).max())  # of sums in another order
    out = []
    for first in range(0, len(q), tile):
        t = slice(first, min(first + tile, len(q)))
        value, error = estimates(q[t], centre, *codes, epsilon)
        value[q_row[t][:, None] == x_row[None, :]] = -np.inf
        least = bar[t].copy()
        if n > k:
            head = np.argpartition(-value, h := min(n - 1, HEAD * k), 1)[:, :h]
            score = np.matmul(x[head], q[t][:, :, None])[:, :, 0]
            score[np.isinf(np.take_along_axis(value, head, 1))] = -np.inf
            least = np.maximum(least, np.partition(score, -k, 1)[:, -k])
        least -= slack[t]
        value += error
        reach = (value >= least[:, None]) & (value > -np.inf)
        near = []
        for m in range(t.stop - t.start):
            j = np.flatnonzero(reach[m])
            score = x.take(j, 0) @ q[first + m]
            floor = max(least[m], np.partition(score, -k)[-k] - slack[first + m]) if len(j) > k else least[m]
            near.append(j[score >= floor])
        i, j = np.repeat(np.arange(t.start, t.stop), [len(c) for c in near]), np.concatenate(near)
        score = exact(q, x, i, j)
        order = np.lexsort((x_row[j], x_id[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append((i[keep], j[keep], score[keep]))
    return [np.concatenate(c) for c in zip(*out)]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list, int]:
    """All usable rows with their codes, the centres by length of vector, and the
    number of rows: ``row, id, d, vector, share`` (hash in 0..1) ``, words, length, a``."""
    spark = vectors.sparkSession
    v = F.col(vector_col)
    usable = F.size(v) > 0
    usable = usable & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    usable = usable & F.exists(v, lambda e: e != 0) & F.col(id_col).isNotNull()
    rows = stored(vectors.where(usable).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        F.size(v).alias("d"), v.alias("vector")), "vectors")
    rows = rows.withColumn("share", F.pmod(F.xxhash64("id", "row"), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    total = rows.count()
    some = rows.where(F.col("share") < F.lit(BLOCK / max(1, total)))
    means = some.select("d", F.posexplode("vector").alias("at", "e")).groupBy("d", "at").agg(F.avg("e").alias("m"))
    centres: dict[int, np.ndarray] = {}
    for r in means.collect():  # one number per component
        centres.setdefault(r.d, np.zeros(r.d))[r.at] = r.m

    def encode(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            d = t.column("d").to_numpy()
            words: list = [None] * len(d)
            length, a = np.zeros(len(d)), np.ones(len(d))
            for one in np.unique(d).tolist():
                at = np.flatnonzero(d == one)
                x = _matrix(t.column("vector").take(pa.array(at)))
                code = Codes(x, centres.get(one, np.zeros(one)))
                length[at], a[at] = code.length, code.a
                for p, w in zip(at.tolist(), code.words):
                    words[p] = w.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(words, pa.binary()), pa.array(length), pa.array(a)],
                [*b.schema.names, "words", "length", "a"])

    kind = rows.schema["vector"].dataType.simpleString()
    coded = rows.mapInArrow(encode, f"row long, id long, d int, vector {kind}, share double, words binary, "
                                    "length double, a double")
    return stored(coded, "codes"), sorted(centres.items()), total


def search(vectors: DataFrame, k: int = K, every: int = EVERY, epsilon: float = EPSILON, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows by inner product
    of every row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    prepare(spark)
    coded, centres, total = index(vectors, id_col, vector_col)
    of = dict(centres)
    asked = coded.where(F.col("id") % every == 0).select(
        F.col("row").alias("query_row"), F.col("id").alias("query_id"), F.col("d").alias("qd"),
        F.col("vector").alias("query"))
    n_asked = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query_row", "query_id"), F.lit(n_asked)))
    best = spark.createDataFrame([], "query_row long, query_id long, row long, vec_id long, score double")

    def pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        names = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()),
                           ("vec_id", pa.int64()), ("score", pa.float64())])
        if not len(left) or not len(right):
            return names.empty_table()
        q, x = _matrix(left.column("query")), _matrix(right.column("vector"))
        words = np.frombuffer(b"".join(right.column("words").to_pylist()), "<u8").reshape(len(x), -1)
        codes = words, right.column("length").to_numpy(), right.column("a").to_numpy()
        q_row, x_row, x_id = (c.to_numpy() for c in (left.column("query_row"), right.column("row"), right.column("id")))
        centre = of.get(q.shape[1], np.zeros(q.shape[1]))
        i, j, score = best_of_block(q, q_row, left.column("bar").to_numpy(), x, x_row, x_id, codes, centre, k, epsilon)
        return pa.table([pa.array(c) for c in (q_row[i], left.column("query_id").to_numpy()[i], x_row[j], x_id[j], score)],
                        schema=names)

    low, rounds = 0.0, max(1, 1 + math.ceil(math.log(max(1, total) / BLOCK, GROWTH)))
    for r in range(rounds):
        high = 2.0 if r == rounds - 1 else BLOCK * GROWTH ** r / total
        n_blocks = max(1, math.ceil((min(high, 1.0) - low) * total / BLOCK))
        held = coded.where((F.col("share") >= low) & (F.col("share") < high)).withColumn(
            "block", F.pmod(F.xxhash64("id", "row", F.lit(r)), F.lit(n_blocks)))
        held = held.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_asked - 1).cast("long"))))
        bars = best.groupBy("query_row").agg(F.count("*").alias("n"), F.min("score").alias("s"))
        bars = bars.where(F.col("n") >= k).select("query_row", F.col("s").alias("bar"))
        now = asked.join(bars, "query_row", "left").withColumn("bar", F.coalesce("bar", F.lit(float("-inf"))))
        now = now.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
        found = now.groupBy("qd", "block", "part").cogroup(held.groupBy("d", "block", "part")).applyInArrow(
            pairs, best.schema)
        order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
        best = stored(best.union(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                      .drop("rank"), "nearest")
        low = high
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return best.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score")
