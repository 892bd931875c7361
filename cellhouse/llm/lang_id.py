"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built.  A text is
parsed against it greedily: a phrase is the longest match in the labelled text
that starts where the last phrase ended, so the longest-match lengths are the
phrase lengths (a symbol the labelled text does not have is a phrase of its own).
A phrase costs log2(length of the labelled text) bits, its place in it; the
language with the fewest bits -- fewest normalised phrases -- wins.

Symbols are lower-cased letters, each letter of any labelled text one of its own,
and only letters of no labelled text match nothing; everything else is one blank.
Long texts are parsed in windows of ``WINDOW`` symbols (a phrase ends with its
window, for all languages alike), which run as parallel lanes of numpy steps: all
windows of a text block times all languages advance one symbol at a time through
one hash table of transitions (state, symbol), so an alphabet costs nothing by its
size.  A worker holds some 8 MB a language at full sample size.

The labelled text is a bounded sample: up to ``SAMPLE_DOCS`` distinct texts of each
language, chosen by hash, ``SAMPLE_CHARS`` characters of each from a place that the
hash chooses too; beyond ``SAMPLE_LANGS`` languages each gets fewer texts, so the
whole stays bounded.  Labels come only from rows outside the held-out third.  A
prediction sees only the text.

Defined results: null texts and texts without a letter give ``und`` with score
0; ties go to the first language in order of name; with no labelled row all is
``und``; repeated rows get a row each; null labels teach nothing; other columns
are ignored (``keep_identified`` keeps them unchanged, and keeps every row with a
letter when there is no labelled row).
"""

from __future__ import annotations

from itertools import chain
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import blocks, free_name, hash_share, is_held_out, prepare

SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_LANGS = 64, 768, 64
WINDOW = 256
BLANK, OTHER = 0, 1
UNKNOWN = "und"
RESULT = "lang_pred string, score double, known double"
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def suffix_automaton(text: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transitions (from, symbol, to) of the automaton of all substrings of
    ``text``.  State 0 is the start; no transition leads there."""
    edges: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        cur = len(link)
        edges.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = cur
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(link)
                edges.append(dict(edges[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    sizes = np.array([len(e) for e in edges])
    symbols = np.fromiter(chain.from_iterable(edges), np.int64, sizes.sum())
    to = np.fromiter(chain.from_iterable(e.values() for e in edges), np.int64, sizes.sum())
    return np.repeat(np.arange(len(edges)), sizes), symbols, to


class Transitions:
    """A hash table (state, symbol) -> state with linear probing, looked up for
    many lanes at once.  0 stands for none."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        left, slot = np.arange(len(keys)), self.slots(keys)
        while len(left):
            free = self.keys[slot] < 0
            _, first = np.unique(np.where(free, slot, -1), return_index=True)
            first = first[free[first]]
            at = slot[first]
            self.keys[at], self.values[at] = keys[left[first]], values[left[first]]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, slot = left[rest], (slot[rest] + 1) & (size - 1)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _SPREAD >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        flat = keys.reshape(-1)
        slot = self.slots(flat)
        held = self.keys.take(slot)
        hit = held == flat
        out = np.where(hit, self.values.take(slot), 0)
        on = np.flatnonzero(~hit & (held >= 0))  # another key lies there: the next slot
        slot = slot[on]
        while len(on):
            slot = (slot + 1) & (len(self.keys) - 1)
            held = self.keys.take(slot)
            hit = held == flat[on]
            out[on[hit]] = self.values.take(slot[hit])
            keep = ~hit & (held >= 0)
            on, slot = on[keep], slot[keep]
        return out.reshape(keys.shape)


class Model:
    """Automata of all languages in one table, built once per worker from the
    labelled texts ``[(language, [text, ...]), ...]``."""

    def __init__(self, labelled: list[tuple[str, list[str]]]):
        self.langs = [name for name, _ in sorted(labelled)]
        letters = sorted({low for _, texts in labelled for t in texts for c in t
                          if c.isalpha() and len(low := c.lower()) == 1})
        self.width = len(letters) + 2
        code = {c: i + 2 for i, c in enumerate(letters)}
        self.code = np.zeros(0x110000, np.int32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                self.code[cp] = code.get(c.lower(), OTHER)
        keys, values, self.roots, self.bits, base = [], [], [], [], 0
        for _, texts in sorted(labelled):
            flat, _ = self.symbols(texts)
            state, symbol, to = suffix_automaton(flat.tolist())
            keep = symbol != OTHER  # such letters match nothing
            keys.append((base + state[keep]) * self.width + symbol[keep])
            values.append(base + to[keep])
            self.roots.append(base)
            base += int(to.max(initial=0)) + 1
            self.bits.append(np.log2(max(2, len(flat))))
        none = [np.zeros(0, np.int64)]
        self.table = Transitions(np.concatenate(keys or none), np.concatenate(values or none).astype(np.int32))
        self.roots, self.bits = np.array(self.roots, np.int64), np.array(self.bits)
        self.first = self.table.get(self.roots[:, None] * self.width + np.arange(self.width)).astype(np.int64)

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts, runs of blanks as one, and where each text's
        begin.  A text's symbols end with a blank."""
        cps = np.frombuffer("".join([t + " " for t in texts]).encode("utf-32-le", "surrogatepass"), "<u4")
        ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        sym = self.code[cps]
        keep = np.ones(len(sym), bool)
        keep[1:] = (sym[1:] != BLANK) | (sym[:-1] != BLANK)
        at = np.concatenate(([0], np.cumsum(keep)))[np.concatenate(([0], ends))]
        return sym[keep], at

    def phrases(self, sym: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Number of phrases of each text (row) in each language (column)."""
        n_lang = len(self.langs)
        n = np.diff(at)
        windows = -(-n // WINDOW)
        text = np.repeat(np.arange(len(n)), windows)
        first = (np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)) * WINDOW
        size = np.minimum(WINDOW, n[text] - first)
        order = np.argsort(-size, kind="stable")
        text, start, size = text[order], (at[text] + first)[order], size[order]
        running = np.searchsorted(-size, -np.arange(WINDOW), "left")  # lanes longer than each step
        root = np.repeat(self.roots[:, None], len(text), 1)
        first = self.first  # where each symbol leads from each start
        state, count = root.copy(), np.zeros((n_lang, len(text)), np.int32)
        for step in range(WINDOW):
            m = int(running[step])
            if not m:
                break
            s = sym[start[:m] + step].astype(np.int64)
            now, base = state[:, :m], root[:, :m]
            nxt = self.table.get(now * self.width + s)
            stop = nxt == 0
            count[:, :m] += stop | (now == base)
            again = first.take(s, 1)
            state[:, :m] = np.where(stop, np.where(again > 0, again, base), nxt)
        out = np.zeros((len(n), n_lang), np.int64)
        for k in range(n_lang):
            out[:, k] = np.bincount(text, count[k], len(n))
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (its share of 2 ** -bits over the languages) and which
        share of the letters any labelled text has."""
        sym, at = self.symbols(texts)
        letters, strange = (np.concatenate(([0], np.cumsum(x))) for x in (sym != BLANK, sym == OTHER))
        n = letters[at[1:]] - letters[at[:-1]]
        share_known = 1 - (strange[at[1:]] - strange[at[:-1]]) / np.maximum(n, 1)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.where(n > 0, 1.0, 0.0)
        bits = self.phrases(sym, at) * self.bits
        best = bits.argmin(1)
        share = 1 / np.exp2(np.minimum(1000, bits.min(1)[:, None] - bits).clip(-1000)).sum(1)
        known = n > 0
        return ([self.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())],
                np.where(known, share, 0.0), np.where(known, share_known, 0.0))


def labelled_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> list[tuple[str, list[str]]]:
    """The bounded sample of labelled rows outside the held-out third."""
    text = F.col(text_col)
    rows = docs.where(~is_held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & text.isNotNull()).select(
        F.col(lang_col).alias("lang"), text.alias("t"), F.xxhash64(text).alias("h"))
    # a share of the distinct texts by hash first, of which the least stay
    total = {r.lang: r.n for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    n_docs = max(1, SAMPLE_DOCS * SAMPLE_LANGS // max(SAMPLE_LANGS, len(total)))
    wanted = F.lit(False)
    for lang, n in sorted(total.items()):
        wanted = wanted | ((F.col("lang") == F.lit(lang)) & hash_share(F.col("h"), 2 * n_docs, n))
    start = F.pmod(F.xxhash64("h"), F.greatest(F.lit(1), F.length("t") - F.lit(SAMPLE_CHARS - 1))) + 1
    some = rows.where(wanted).select("lang", "h", F.substr("t", start.cast("int"), F.lit(SAMPLE_CHARS)).alias("t"))
    some = some.groupBy("lang", "h").agg(F.min("t").alias("t"))
    order = Window.partitionBy("lang").orderBy("h")
    by: dict[str, list[str]] = {}
    for r in some.withColumn("n", F.row_number().over(order)).where(F.col("n") <= n_docs).collect():
        by.setdefault(r.lang, []).append((r.n, r.t))
    return [(lang, [t for _, t in sorted(ts)]) for lang, ts in sorted(by.items())]


_MODELS: dict[int, Model] = {}


def predictor(spark, labelled: list[tuple[str, list[str]]]):
    """A function of a text column giving ``RESULT``."""
    key = hash(tuple((n, *t) for n, t in labelled))
    shared = spark.sparkContext.broadcast(labelled)  # at most SAMPLE_DOCS * SAMPLE_CHARS characters a language
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("known", pa.float64())])

    @F.arrow_udf(StructType.fromDDL(RESULT))
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if key not in _MODELS:
            _MODELS.clear()
            _MODELS[key] = Model(shared.value)
        for arr in texts:
            langs, scores, known = [], [], []
            for _, run in blocks(arr):
                got, score, share = _MODELS[key].predict(run.to_pylist())
                langs += got
                scores += score.tolist()
                known += share.tolist()
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(known, pa.float64())],
                fields=list(kind))

    return predict


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    prepare(docs.sparkSession)
    predict = predictor(docs.sparkSession, labelled_sample(docs, id_col, text_col, lang_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), is_held_out(F.col(id_col)).alias("held_out"),
                       predict(F.col(text_col)).alias("r"))
    return rows.select("doc_id", "held_out", "r.lang_pred", "r.score")


def keep_identified(docs: DataFrame, wanted: list[str] | None = None, least: float = 0.0, least_known: float = 0.5,
                    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows whose text is in one of the ``wanted`` languages (None: any labelled one)
    with a score of ``least``, all columns unchanged.  A text of which less than
    ``least_known`` of the letters occur in any labelled text is in none of them.
    With nothing labelled, every text with a letter stays."""
    prepare(docs.sparkSession)
    labelled = labelled_sample(docs, id_col, text_col, lang_col)
    found = free_name(docs.columns, "found")
    rows = docs.withColumn(found, predictor(docs.sparkSession, labelled)(F.col(text_col)))
    keep = F.col(found)["known"] >= (least_known if labelled else 1.0)
    if labelled:
        keep = keep & (F.col(found)["lang_pred"] != UNKNOWN) & (F.col(found)["score"] >= least)
        if wanted is not None:
            keep = keep & F.col(found)["lang_pred"].isin(list(wanted))
    return rows.where(keep).drop(found)
