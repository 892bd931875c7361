"""Benchmark decontamination by winnowing.

Both sides are cut into words; of every ``WINNOW`` consecutive k-gram hashes the
least one is kept (rightmost on ties).  With ``K + WINNOW - 1 = 13`` each shared
run of 13 words keeps at least one common k-gram in the same place, so the join
of the kept fingerprints misses no shared window.  A joined fingerprint is then
extended to both sides: each 13-word window around it is looked up among the
items' windows and checked on the words themselves; overlapping hits are one span.  Items of fewer than 13 words are one window: they
are joined by the hash of their whole sequence (one sliding hash for each
length present), checked on the words as well.

The benchmark is dealt into parts of bounded bytes.  A part's fingerprints are
broadcast; the documents stream past them, whole texts, without a shuffle.
A (window, item) pair is looked up once however often the item repeats it.  More
than one part means more than one pass over the documents, whose hit spans are
united per document (``find_hits``); so the broadcast never grows.

Defined results: a null or wordless text has no words, no hits and is clean;
null item ids and texts without words give no window; repeated items count
once; repeated documents get a row each; an empty benchmark hits nothing; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import (blocks, byte_class, flat, free_name, prepare, span_hashes, spans, stored, window_hashes, window_hashes_at)

WINDOW, K = 13, 6
WINNOW = WINDOW - K + 1
PART_BYTES = 8 << 20

#: words are runs of digits, letters and bytes beyond ASCII (after lower-casing A-Z)
_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_CLASS = byte_class(_SEPARATORS)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def words_of(run: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, word hashes, first word of each text) of a run of texts."""
    data, off = flat(run)
    starts, ends = spans(_CLASS[data])
    return data, starts, ends, span_hashes(data, starts, ends, fold_case=True), np.searchsorted(starts, off)


def winnow(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept k-grams: (index of the first word, hash), for texts whose words are
    ``h[bounds[i]:bounds[i + 1]]``."""
    grams = window_hashes(h, K)
    if len(grams) < WINNOW:
        grams = np.concatenate((grams, np.full(WINNOW - len(grams), _LAST)))
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    owner = np.concatenate((owner, np.full(max(0, len(grams) + K - 1 - len(owner)), -1)))
    grams[owner[: len(grams)] != owner[K - 1: K - 1 + len(grams)]] = _LAST  # runs over the end of a text
    best, at = grams, np.arange(len(grams))
    step, width = 1, 1
    while width < WINNOW:  # least of the next 2, 4, 8 ... grams, rightmost on ties
        step = min(width, WINNOW - width)
        a, b = best[:-step], best[step:]
        right = b <= a
        best, at = np.where(right, b, a), np.where(right, at[step:], at[:-step])
        width += step
    keep = np.unique(at)
    keep = keep[grams[keep] != _LAST]
    return keep, grams[keep]


class Part:
    """One part of the benchmark, built once per worker: the kept fingerprints
    of its items, and for extension their 13-word windows, each (window, item)
    once, by hash and with a place where its words stand."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = sorted({i for i, _ in items})
        where = {i: n for n, i in enumerate(self.ids)}
        texts = pa.array([t for _, t in items], pa.large_string())
        self.data, self.starts, self.ends, self.h, self.bounds = words_of(texts)
        item = np.array([where[i] for i, _ in items], np.int64)  # of each text
        n = np.diff(self.bounds)
        text = np.repeat(np.arange(len(n)), n)
        at, fp = winnow(self.h, self.bounds)
        self.fp = np.unique(fp[n[text[at]] >= WINDOW])
        #: by window length: (hash, item, place), ascending
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in sorted({WINDOW, *n[(n > 0) & (n < WINDOW)].tolist()}):
            g = window_hashes(self.h, k)
            p = np.flatnonzero(text[: len(g)] == text[k - 1:][: len(g)])
            p = p[(n[text[p]] == k) | (k == WINDOW)]  # a shorter window is a whole item
            p = p[np.lexsort((p, item[text[p]], g[p]))]
            new = np.ones(len(p), bool)
            new[1:] = (g[p][1:] != g[p][:-1]) | (item[text[p]][1:] != item[text[p]][:-1])
            self.windows[k] = g[p][new], item[text[p]][new], p[new]

    def words(self, a: int, b: int) -> list[bytes]:
        return [self.data[s:e].tobytes().lower() for s, e in zip(self.starts[a:b], self.ends[a:b])]


def _member(table: np.ndarray, probe: np.ndarray) -> np.ndarray:
    """Which values are in the sorted table."""
    if not len(table):
        return np.zeros(len(probe), bool)
    return table[np.minimum(np.searchsorted(table, probe), len(table) - 1)] == probe


def _hashes_at(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """``window_hashes(h, k)[at]``, without the others."""
    return window_hashes(h, k)[at] if 4 * len(at) > len(h) else window_hashes_at(h, at, k)


def _matches(table: np.ndarray, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (index into probe, index into the sorted table) of equal values."""
    lo, hi = np.searchsorted(table, probe, "left"), np.searchsorted(table, probe, "right")
    n = hi - lo
    hit = np.flatnonzero(n)
    n = n[hit]
    return np.repeat(hit, n), np.repeat(lo[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def spans_in(run: pa.Array, part: Part) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
    """Number of words of each text, and the hits (text, item index, first word,
    end word), words counted within the text."""
    data, starts, ends, h, bounds = words_of(run)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    hits: list[tuple[int, int, int, int]] = []
    for k, (table, item, place) in part.windows.items():
        if len(h) < k or not len(table):
            continue
        if k == WINDOW:
            # a joined fingerprint is extended: all windows around its k-gram
            at, fp = winnow(h, bounds)
            at = at[_member(part.fp, fp)]
            at = np.unique((at[:, None] - np.arange(WINNOW)[None, :]).ravel())
            at = at[(at >= 0) & (at + k <= len(h))]
        else:
            at = np.arange(len(h) - k + 1)
        at = at[text[at] == text[at + k - 1]]
        mine, theirs = _matches(table, _hashes_at(h, at, k))
        for i, j in zip(at[mine].tolist(), theirs.tolist()):
            s = int(place[j])
            if [data[x:y].tobytes().lower() for x, y in zip(starts[i: i + k], ends[i: i + k])] == part.words(s, s + k):
                d = int(text[i])
                hits.append((d, int(item[j]), i - int(bounds[d]), i + k - int(bounds[d])))
    found: list[tuple[int, int, int, int]] = []
    for d, item, a, b in sorted(hits):  # windows that overlap or touch are one span
        if found and found[-1][:2] == (d, item) and a <= found[-1][3]:
            found[-1] = (d, item, found[-1][2], max(b, found[-1][3]))
        else:
            found.append((d, item, a, b))
    return np.diff(bounds), found


_PARTS: dict[str, Part] = {}


def _part(key: str, shared) -> Part:
    """One part at a time is kept per worker process."""
    if key not in _PARTS:
        _PARTS.clear()
        _PARTS[key] = Part(shared.value)
    return _PARTS[key]


def benchmark_parts(items: DataFrame, part_bytes: int = PART_BYTES, id_col: str = "item_id",
                    text_col: str = "text") -> tuple[int, Iterator]:
    """The number of parts and the benchmark as broadcasts of at most about
    ``part_bytes`` each (a single longer item is a part of its own), made one by one:
    the driver holds one part at a time."""
    spark = items.sparkSession
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where(
        "i is not null and t is not null").distinct()
    size = rows.agg(F.sum(F.octet_length("t") + 64)).first()[0] or 0
    n = max(1, -(-size // part_bytes))
    if n > 1:
        rows = stored(rows.withColumn("p", F.pmod(F.xxhash64("i", "t"), F.lit(n))), "benchmark")

    def parts():
        for p in range(n):
            some = rows.where(F.col("p") == p) if n > 1 else rows
            shared = spark.sparkContext.broadcast(sorted((r.i, r.t) for r in some.select("i", "t").collect()))
            yield uuid.uuid4().hex, shared
            if n > 1:
                shared.destroy()

    return n, parts()


RESULT = ("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "hits array<struct<item_id:bigint,first:bigint,stop:bigint>>")


def _verdict(n_words: int, hits: list[tuple[int, int, int]], min_share: int) -> dict:
    n_hit, end = 0, 0
    for _, a, b in sorted(hits, key=lambda x: x[1:]):
        n_hit += max(0, b - max(a, end))
        end = max(end, b)
    ids = sorted({str(i) for i, _, _ in hits})
    return {"n_words": n_words, "n_hit": n_hit, "n_items": len(ids),
            "items_sha256": hashlib.sha256(",".join(ids).encode()).hexdigest(),
            "contaminated": n_hit > 0 and min_share * n_hit >= n_words,
            "hits": [{"item_id": i, "first": a, "stop": b} for i, a, b in hits]}


def RESULT_TYPE():
    return StructType.fromDDL(RESULT)


@lru_cache(maxsize=None)
def _arrow_type():
    hit = pa.struct([("item_id", pa.int64()), ("first", pa.int64()), ("stop", pa.int64())])
    return pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                      ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("hits", pa.list_(hit))])


def contamination(part_of, min_share: int = 20):
    """A function of a text column giving ``RESULT`` against one broadcast part.
    A text is contaminated if ``n_hit > 0`` and ``min_share * n_hit >= n_words``."""
    key, shared = part_of

    @F.arrow_udf(RESULT_TYPE())
    def check(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        part = _part(key, shared)
        for arr in texts:
            out = []
            for _, run in blocks(arr):
                n_words, found = spans_in(run, part)
                by: dict[int, list] = {}
                for d, item, a, b in found:
                    by.setdefault(d, []).append((part.ids[item], a, b))
                out += [_verdict(n, by.get(d, []), min_share) for d, n in enumerate(n_words.tolist())]
            yield pa.array(out, _arrow_type())

    return check


def _united(docs: DataFrame, parts: Iterator, min_share: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, t, n, r``: the verdict on the united hit spans of several passes,
    a row for each id and text with its number of rows.  ``t``, a hash of the
    text, tells documents of equal id apart."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    key, base, hits = ["doc_id", "t"], None, None
    for p in parts:  # a pass is written before the next part is made
        one = rows.select("doc_id", F.xxhash64("text").alias("t"), contamination(p, min_share)("text").alias("r"))
        one = stored(one.select(*key, "r.n_words", "r.hits") if base is None else
                     one.where("r.n_hit > 0").select(*key, "r.hits"), "benchmark-pass")
        if base is None:
            base = one.groupBy(*key).agg(F.max("n_words").alias("n_words"), F.count("*").alias("n"))
        found = one.select(*key, F.explode("hits").alias("h"))
        hits = found if hits is None else hits.union(found)
    hits = hits.distinct().groupBy(*key).agg(F.array_sort(F.collect_list("h")).alias("hits"))

    @F.arrow_udf(RESULT_TYPE())
    def united(n_words: pa.Array, hits: pa.Array) -> pa.Array:
        return pa.array([_verdict(n, [(h["item_id"], h["first"], h["stop"]) for h in hs or []], min_share)
                         for n, hs in zip(n_words.to_pylist(), hits.to_pylist())], _arrow_type())

    h = hits.select(F.col("doc_id").alias("hd"), F.col("t").alias("ht"), "hits")
    both = base.join(h, base.doc_id.eqNullSafe(h.hd) & (base.t == h.ht), "left")
    return both.select("doc_id", "t", "n", united("n_words", "hits").alias("r"))


def find_hits(docs: DataFrame, items: DataFrame, min_share: int = 20, part_bytes: int = PART_BYTES,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and the columns of ``RESULT``."""
    prepare(docs.sparkSession)
    n, parts = benchmark_parts(items, part_bytes)
    if n == 1:
        return docs.select(F.col(id_col).alias("doc_id"),
                           contamination(next(parts), min_share)(F.col(text_col)).alias("r")).select("doc_id", "r.*")
    # identical rows keep a row each through n
    both = _united(docs, parts, min_share, id_col, text_col)
    return both.select("doc_id", "r",
                       F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")).select("doc_id", "r.*")


def without_contaminated(docs: DataFrame, items: DataFrame, min_share: int = 20, part_bytes: int = PART_BYTES,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated (by the verdict of ``find_hits``),
    all their columns unchanged."""
    prepare(docs.sparkSession)
    n, parts = benchmark_parts(items, part_bytes)
    if n == 1:
        name = free_name(docs.columns, "c")
        return docs.withColumn(name, contamination(next(parts), min_share)(F.col(text_col))).where(
            f"not `{name}`.contaminated").drop(name)
    i, t = free_name(docs.columns, "i"), free_name(docs.columns, "t")
    bad = stored(_united(docs, parts, min_share, id_col, text_col).where("r.contaminated").select(
        F.col("doc_id").alias(i), F.col("t").alias(t)), "contaminated")
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col(i)) & (F.xxhash64(text_col) == F.col(t)), "left_anti")
