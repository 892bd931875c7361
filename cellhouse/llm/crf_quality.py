"""Quality classifier: a linear-chain conditional random field over lines.

Every line with a word is good or bad.  Features of a line, of the line before
and of the line after it score the two states, a matrix scores neighbouring
states; forward-backward gives each line's probability of being good, and a
document's score is their mean weighted by words.

Training: ``SAMPLE_DOCS`` labelled documents (least hash of the id) outside the
held-out third; each of their lines takes the document's label.  Features are
extracted by Spark; the sample's features (a bounded number of documents) are
fitted by gradient ascent on the regularised log-likelihood, full batch and
without randomness.  Labels, language, source and id are never features.

Defined results: texts without a word score 0; with no labelled row every other
text scores 0.5; repeated rows get a row each; null ids are never held out;
labels that contradict each other for one id are both ignored; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import blocks, byte_class, is_held_out, prepare
from .lines import SYMBOLS, Lines

SAMPLE_DOCS, SAMPLE_LINES = 3000, 400
STEPS, RATE, L2 = 200, 0.1, 1e-3
CUTS = (0.1, 0.3, 0.5, 0.7, 0.9)
MAX_SCORE = 30.0


def _class(chars: bytes) -> np.ndarray:
    return 1 - byte_class(chars)


_UPPER, _DIGIT = _class(bytes(range(65, 91))), _class(bytes(range(48, 58)))
_LETTER = _class(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_STOP, _LOUD, _PAUSE = _class(b".?\"'):"), _class(b"!"), _class(b",.;:?-'\"()")
_WIDE = _class(bytes(range(128, 256)))


def line_features(x: Lines) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, words, first kept line of each text) of the lines with a word."""
    at = np.flatnonzero(x.line_words > 0)
    a, b = x.ls[at], x.le[at]

    def total(cls: np.ndarray) -> np.ndarray:
        c = np.concatenate(([0], np.cumsum(cls, dtype=np.int64)))
        return (c[b] - c[a]).astype(np.float64)

    w0, w1 = x.lw[:-1][at], x.lw[1:][at]
    words = (w1 - w0).astype(np.float64)

    def of_words(values: np.ndarray) -> np.ndarray:
        c = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
        return (c[w1] - c[w0]).astype(np.float64)

    length = x.ends - x.starts
    line = np.repeat(np.arange(len(at)), w1 - w0)
    inside = x.hash ^ (line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(inside, kind="stable")
    again = np.zeros(len(inside), bool)
    again[order[1:]] = inside[order[1:]] == inside[order[:-1]]
    echo = np.zeros(len(inside), bool)
    echo[1:] = inside[1:] == inside[:-1]
    size = np.maximum(1, of_words(length))
    letters = np.maximum(1, total(_LETTER[x.data]))
    last, first = x.data[x.ends[w1 - 1] - 1], x.data[x.starts[w0]]
    f = np.stack([
        np.log2(1 + words), of_words(length) / words, total(_UPPER[x.data]) / letters,
        total(_DIGIT[x.data]) / size, total(SYMBOLS[x.data]) / size, total(_LOUD[x.data]) / size,
        total(_PAUSE[x.data]) / size, total(_WIDE[x.data]) / size, _STOP[last], _UPPER[first],
        of_words(again) / words, of_words(echo) / words, of_words(x.repeated_words()) / words, x.repeated_lines()[at],
        of_words(length == 1) / words, of_words(length > 24) / words], 1)
    return f, words, np.searchsorted(at, x.lb)


def design(f: np.ndarray, bounds: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Rows of the model: a line's features above each cut, those of its
    neighbours (zero at the ends), a constant, first-line and last-line flags."""
    own = (f[:, :, None] > cuts[None]).reshape(len(f), -1).astype(np.float32)
    own = np.concatenate((own, np.minimum(f, 20).astype(np.float32) / 4), 1)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    first = np.zeros(len(f), bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    last = np.zeros(len(f), bool)
    last[bounds[1:][np.diff(bounds) > 0] - 1] = True
    before[first], after[last] = 0, 0
    return np.concatenate((own, before, after, np.ones((len(f), 1), np.float32), first[:, None], last[:, None]), 1)


class Chains:
    """Chains of different lengths side by side, longest first: step t touches a
    prefix of the lanes."""

    def __init__(self, bounds: np.ndarray):
        n = np.diff(bounds)
        order = np.argsort(-n, kind="stable")
        order = order[n[order] > 0]
        self.start, self.n = bounds[:-1][order], n[order]
        self.steps = int(self.n[0]) if len(order) else 0
        self.lanes = np.searchsorted(-self.n, -np.arange(self.steps), "left")

    def marginals(self, score: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability of good per line, expected transitions) by forward-backward.
        ``score``: of good against bad; ``trans[i, j]``: from state i to j."""
        psi = np.ones((len(score), 2))
        psi[:, 1] = np.exp(np.clip(score, -MAX_SCORE, MAX_SCORE))
        m = np.exp(trans)
        fwd = np.zeros((len(score), 2))
        for t in range(self.steps):
            at = self.start[: self.lanes[t]] + t
            v = psi[at] if t == 0 else (fwd[at - 1] @ m) * psi[at]
            fwd[at] = v / v.sum(1, keepdims=True)
        good = np.zeros(len(score))
        pairs = np.zeros((2, 2))
        back = np.ones((len(self.n), 2))
        for t in range(self.steps - 1, -1, -1):
            k = self.lanes[t]
            at = self.start[:k] + t
            p = fwd[at] * back[:k]
            good[at] = p[:, 1] / p.sum(1)
            if t:
                out = psi[at] * back[:k]
                joint = fwd[at - 1][:, :, None] * m[None] * out[:, None, :]
                pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
                b = out @ m.T
                back[:k] = b / b.sum(1, keepdims=True)
        return good, pairs


def fit(f: np.ndarray, bounds: np.ndarray, label: np.ndarray) -> dict:
    """Weights from line features, chain bounds and one label (0/1) per chain."""
    cuts = np.quantile(f, CUTS, axis=0).T
    x = design(f, bounds, cuts)
    y = np.repeat(label, np.diff(bounds)).astype(np.float64)
    chains = Chains(bounds)
    inner = np.diff(bounds)[np.diff(bounds) > 0] - 1
    kept = label[np.diff(bounds) > 0]
    seen = np.diag([float(inner[kept == 0].sum()), float(inner[kept == 1].sum())])
    w, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    mean = [np.zeros_like(w), np.zeros_like(trans)]
    square = [np.zeros_like(w), np.zeros_like(trans)]
    for step in range(1, STEPS + 1):
        good, pairs = chains.marginals(x @ w, trans)
        for k, (p, g) in enumerate(((w, x.T @ (y - good) / len(y) - L2 * w),
                                    (trans, (seen - pairs) / len(y) - 30 * L2 * trans))):
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            p += RATE * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)
    return {"cuts": cuts, "w": w, "trans": trans}


def score_texts(run: pa.Array, model: dict | None) -> np.ndarray:
    x = Lines(run)
    f, words, bounds = line_features(x)
    has = np.diff(bounds) > 0
    if model is None:
        return np.where(has, 0.5, 0.0)
    score = design(f, bounds, model["cuts"]) @ model["w"]
    good, _ = Chains(bounds).marginals(score, model["trans"])
    c, n = np.concatenate(([0], np.cumsum(good * words))), np.concatenate(([0], np.cumsum(words)))
    top, all_ = c[bounds[1:]] - c[bounds[:-1]], n[bounds[1:]] - n[bounds[:-1]]
    return np.where(has, np.clip(top / np.maximum(1, all_), 0, 1), 0.0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> dict | None:
    """A model from the bounded sample: ``SAMPLE_DOCS`` labelled ids chosen by hash (of
    rows of equal id the least text) and of each at most ``SAMPLE_LINES`` lines with a
    word, which follow each other from a place that their hash chooses.  None without
    labelled texts of both kinds."""
    prepare(docs.sparkSession)
    marks = labels.select(F.col(id_col).alias("i"), F.col(label_col).alias("y")).where(
        F.col("i").isNotNull() & F.col("y").isin(0, 1) & ~is_held_out(F.col("i")))
    marks = marks.groupBy("i").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z")
    marks = marks.orderBy(F.xxhash64("i"), "i").limit(SAMPLE_DOCS).select("i", "y")
    rows = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t")).join(
        F.broadcast(marks), F.col("d") == F.col("i"))  # SAMPLE_DOCS rows
    rows = rows.groupBy("d", "y").agg(F.min("t").alias("t"))
    most = SAMPLE_LINES

    def some(f: np.ndarray) -> bytes:
        f = f.astype("<f4")
        first = zlib.crc32(f.tobytes()) % max(1, len(f) - most + 1)
        return f[first:first + most].tobytes()

    def extract(batches):
        for b in batches:
            for first, run in blocks(b.column(2)):
                f, _, bounds = line_features(Lines(run))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(run)), b.column(1).slice(first, len(run)),
                     pa.array([some(f[i:j]) for i, j in zip(bounds[:-1], bounds[1:])], pa.binary())],
                    ["d", "y", "f"])

    # at most SAMPLE_DOCS * SAMPLE_LINES lines
    got = rows.select(F.col("d").cast("long"), F.col("y").cast("int"), "t").mapInArrow(
        extract, "d long, y int, f binary").collect()
    got = sorted((r.d, r.y, bytes(r.f)) for r in got if r.f)
    if len({y for _, y, _ in got}) < 2:
        return None
    width = len(line_features(Lines(pa.array(["a"], pa.large_string())))[0][0])
    each = [np.frombuffer(f, "<f4").reshape(-1, width).astype(np.float64) for _, _, f in got]
    return fit(np.concatenate(each), np.concatenate(([0], np.cumsum([len(e) for e in each]))),
               np.array([y for _, y, _ in got]))


def quality_of(text: Column, model: dict | None) -> Column:
    @F.arrow_udf(DoubleType())
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in texts:
            out = [score_texts(run, model) for _, run in blocks(arr)]
            yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return score(text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    model = train(docs, labels, id_col, text_col, label_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), is_held_out(F.col(id_col)).alias("held_out"),
                       quality_of(F.col(text_col), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
