"""SimHash near-duplicates, searched with vantage-point trees.

Fingerprint: whole text, A-Z lower-cased, words, 4-word shingles with repeats,
XXH64 (seed 42) of each; a bit is set if it is set in over half of the hashes.

Search, on distinct fingerprints only (copies collapse first):

* A pair within ``MAX_BITS`` = 4 differs in none of the bits of at least one of
  five bit blocks.  Each block has a vantage-point tree whose distances are
  measured on the block's bits: a fingerprint goes to the shell of its distance
  to each vantage point.  By the triangle inequality two fingerprints whose
  shells differ by more than the distance left to the block -- none -- cannot be
  such a pair, so one shard per tree is enough and no branch beside it is
  visited.  With very many fingerprints ``levels`` of blocks are nested, which
  keeps shards small.
* Inside a shard the tree goes on over all 64 bits (``link_shard``): a vantage
  point splits its set at the median distance ``mu``; the near side also takes
  the boundary shell ``mu < d <= mu + 4``, whose members may have partners on
  both sides.  If a vantage point has partners itself, its ball is joined
  whole: only the shell ``4 < d <= 8`` can have links into the ball, all others
  are pruned.  So a large group of near copies costs a pass per ball, not all
  pairs, and a shard emits a forest: at most one row per fingerprint.
* The forests of all shards go to ``components``.

A shard holds about n / 2^13 of n distinct fingerprints (n / 2^23 with two
levels), 8 bytes each.

Defined results: null, empty and blank texts have fingerprint zero and are
linked like any other; repeated rows share fingerprint and component; the
component id is the least non-null document id (null if there is none); an
empty table gives no rows; other columns are ignored by ``near_duplicates`` and
kept unchanged by ``without_duplicates``.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import blocks, free_name, prepare, stored
from .components import components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
VANTAGE_POINTS = 8
SHARD_TARGET = 4096
SMALL_SET = 192


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and ASCII blanks only
    if not words:
        return 0
    k = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, (ends[k - 1:] - 1).tolist())), "<u8",
                    len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[i: i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprint_of(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit column."""

    @F.arrow_udf(LongType())
    def simhash(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in texts:
            out = [fingerprint(t, shingle) for _, run in blocks(arr) for t in run.to_pylist()]
            yield pa.array(np.array(out, np.uint64).view(np.int64))

    return simhash(text)


# ------------------------------------------------------------------- the trees


def tree_masks(max_bits: int, levels: int) -> list[int]:
    """The bits on which each tree's vantage distances are measured: one of
    ``max_bits + 1`` blocks of the 64 bits, at each further level also one of as
    many blocks of the bits that are left."""
    masks = [0]
    for _ in range(levels):
        out = []
        for m in masks:
            left = [b for b in range(64) if not m >> b & 1]
            for part in np.array_split(left, max_bits + 1):
                out.append(m | sum(1 << int(b) for b in part))
        masks = out
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def shards(classes: DataFrame, max_bits: int, levels: int) -> DataFrame:
    """``fp, shard``: a row per fingerprint and tree."""
    points = np.random.default_rng(7).integers(0, 1 << 64, VANTAGE_POINTS * levels, dtype=np.uint64).tolist()
    fp = F.col("fp")
    paths = []
    for t, m in enumerate(tree_masks(max_bits, levels)):
        shells = [F.bit_count((fp.bitwiseXOR(F.lit(_signed(p)))).bitwiseAND(F.lit(_signed(m)))) for p in points]
        paths.append(F.xxhash64(F.lit(t), *shells))
    return classes.select("fp", F.explode(F.array(*paths)).alias("shard"))


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def link_shard(f: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links among distinct fingerprints ``f`` (uint64): pairs
    of members of one component, at most about one per fingerprint and side."""
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []

    def emit(x, y):
        a.append(x)
        b.append(y)

    todo = [f]
    while todo:
        s = todo.pop()
        if len(s) <= SMALL_SET:
            near = _distance(s[:, None], s[None, :]) <= max_bits
            if int(near.sum()) > len(s):
                label = np.arange(len(s))
                while True:  # least label of the neighbours, until nothing changes
                    new = np.where(near, label[None, :], len(s)).min(1)
                    if (new == label).all():
                        break
                    label = new
                x = np.flatnonzero(label != np.arange(len(s)))
                emit(s[x], s[label[x]])
            continue
        v = s[len(s) // 2]
        d = _distance(s, v)
        ball = s[d <= max_bits]
        rest = s[d > max_bits]
        if len(ball) > 1:  # the ball is one component; only the shell around it can have links into it
            emit(ball, np.full(len(ball), v))
            shell = s[(d > max_bits) & (d <= 2 * max_bits)]
            step = max(1, (1 << 20) // max(1, len(shell)))
            for i in range(0, len(ball), step):
                if not len(shell):
                    break
                hit = _distance(shell[:, None], ball[None, i: i + step]) <= max_bits
                linked = hit.any(1)
                emit(shell[linked], np.full(int(linked.sum()), v))
                shell = shell[~linked]
            todo.append(rest)
            continue
        d = _distance(rest, v)
        mu = int(np.median(d))
        inner, outer = rest[d <= mu + max_bits], rest[d > mu]
        # all at nearly one distance: this point splits nothing, but it is done with
        todo += [inner, outer] if max(len(inner), len(outer)) < len(rest) else [rest]
    if not a:
        return f[:0], f[:0]
    x, y = np.concatenate(a), np.concatenate(b)
    return x[x != y], y[x != y]


def links(classes: DataFrame, max_bits: int = MAX_BITS, levels: int | None = None) -> DataFrame:
    """Edges ``u, v`` whose components are those of the fingerprints ``fp``
    (distinct, a stored table) at ``max_bits`` or fewer differing bits."""
    prepare(classes.sparkSession)
    if levels is None:
        n, levels = classes.count(), 1
        while n >> _least_bits(max_bits, levels) > SHARD_TARGET and levels < 3:
            levels += 1
    routed = shards(classes, max_bits, levels).repartition("shard").sortWithinPartitions("shard", "fp")

    def search(batches):
        held: list[np.ndarray] = []
        last = None
        xs: list[np.ndarray] = []
        ys: list[np.ndarray] = []

        def close():
            s = np.concatenate(held) if len(held) > 1 else held[0]
            if len(s) > 1:
                x, y = link_shard(s, max_bits)
                xs.append(x)
                ys.append(y)

        def out():
            x = np.concatenate(xs).view(np.int64) if xs else np.zeros(0, np.int64)
            y = np.concatenate(ys).view(np.int64) if ys else np.zeros(0, np.int64)
            xs.clear()
            ys.clear()
            return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["u", "v"])

        for batch in batches:
            shard = batch.column("shard").to_numpy()
            f = batch.column("fp").to_numpy().view(np.uint64)
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if last is not None and shard[i] != last:
                    close()
                    held = []
                last = shard[i]
                held.append(f[i:j])
            yield out()
        if held:
            close()
            yield out()

    return routed.mapInArrow(search, "u long, v long")


def _least_bits(max_bits: int, levels: int) -> int:
    return min(bin(m).count("1") for m in tree_masks(max_bits, levels))


def _grouped(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, t, fp) of every row, and (fp, rep) with the first row of each
    fingerprint's component: least id, nulls last, then least text hash ``t``."""
    prepare(docs.sparkSession)
    rows = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("t"),
                              fingerprint_of(F.col(text_col), shingle).alias("fp")), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "t")).alias("rep")
    classes = stored(rows.groupBy("fp").agg(first), "classes")
    star = components(links(classes.select("fp"), max_bits))
    rooted = classes.join(star, classes.fp == star.u, "left").select(
        "fp", F.coalesce("v", "fp").alias("root"), "rep")
    best = rooted.groupBy("root").agg(F.min("rep").alias("rep"))
    return rows, rooted.select("fp", "root").join(best, "root").select("fp", "rep")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    rows, groups = _grouped(docs, shingle, max_bits, id_col, text_col)
    return rows.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("rep.doc_id").alias("component_id"))


def without_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row of each component stays: that of the least document id (nulls
    last, then least text hash); all columns unchanged."""
    rows, groups = _grouped(docs, shingle, max_bits, id_col, text_col)
    reps = stored(groups.select("rep").distinct(), "kept").select(
        F.col("rep.doc_id").alias("_i"), F.col("rep.t").alias("_t"))
    key, text = free_name(docs.columns, "key"), free_name(docs.columns, "hash")
    kept = docs.withColumns({key: F.col(id_col).cast("long"), text: F.xxhash64(text_col)})
    kept = kept.join(reps, kept[key].eqNullSafe(reps["_i"]) & (kept[text] == reps["_t"]), "left_semi")
    repeated = rows.groupBy("doc_id", "t").count().where("count > 1").limit(1).count()
    if repeated:  # rows that agree in id and text: one of them
        kept = kept.dropDuplicates([key, text])
    return kept.drop(key, text)
