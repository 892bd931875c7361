"""Quality rules: cross-document line frequency.

1. Per text (numpy over whole texts): the base counts, and for each different
   normalised line its hash and number of words.
2. Document frequency of each line within its host: rows of one line and
   document are made distinct, then counted per (host, line) -- summed in the
   map tasks first, so a line that a third of all documents share costs one row
   a task.
3. Lines found in more than ``max_docs`` documents of a host are removed.  A
   document is depleted if less than ``min_left`` per cent of its words or less
   than ``min_words`` words are left.

Normalised: A-Z lower-cased, any run of blanks as one.  A document is an id and
a text: repeated rows count once and get the same verdict in a row each.

Defined results: null, empty and blank texts have no words and fail the base
rule; a null host is a host of its own; null ids are told apart by their text;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, per_text, prepare, stored
from .lines import SYMBOLS, Lines

MAX_DOCS, MIN_LEFT, MIN_WORDS = 50, 50, 20
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def text_counts(x: Lines) -> list[np.ndarray]:
    """The columns ``BASE`` of each text."""
    points = (x.data & 0xC0) != 0x80  # first bytes of code points
    return [np.diff(x.wb), per_text(points & (x.is_word > 0), x.off), per_text(SYMBOLS[x.data], x.off),
            per_text(x.repeated_lines(), x.lb), per_text(x.repeated_words(), x.wb)]


def _line_rows(x: Lines) -> pa.Array:
    """For each text the list of its different lines: hash and number of words."""
    at = np.flatnonzero(x.line_words > 0)
    h, t, w = x.normal_lines()[at], x.line_text[at], x.line_words[at]
    order = np.lexsort((h, t))
    h, t, w = h[order], t[order], w[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    begin = np.flatnonzero(first)
    words = np.add.reduceat(w, begin) if len(begin) else w
    offsets = np.searchsorted(t[begin], np.arange(x.n + 1))
    rows = pa.StructArray.from_arrays([pa.array(h[begin].view(np.int64)), pa.array(words, pa.int64())], ["h", "w"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``doc_id, host, t`` (text hash), the base counts and ``lines`` of every row."""
    prepare(docs.sparkSession)

    def read(batches):
        for b in batches:
            for first, run in blocks(b.column(3)):
                x = Lines(run)
                cols = [b.column(i).slice(first, len(run)) for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    cols + [pa.array(c, pa.int64()) for c in text_counts(x)] + [_line_rows(x)],
                    ["doc_id", "host", "t", *BASE, "lines"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                       F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    return rows.mapInArrow(read, "doc_id long, host string, t long, " + ", ".join(f"{c} long" for c in BASE)
                           + ", lines array<struct<h:bigint,w:bigint>>")


def judge(docs: DataFrame, max_docs: int = MAX_DOCS, min_left: int = MIN_LEFT, min_words: int = MIN_WORDS,
          id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``removed_words`` and ``kept``."""
    rows = stored(line_table(docs, id_col, text_col, host_col), "lines")
    seen = rows.select("doc_id", "t", "host", F.explode("lines").alias("l")).select(
        "doc_id", "t", "host", "l.h", "l.w").distinct()
    frequent = seen.groupBy("host", "h").count().where(F.col("count") > max_docs).select(
        F.col("host").alias("fhost"), F.col("h").alias("fh"))
    removed = seen.join(frequent, seen.host.eqNullSafe(F.col("fhost")) & (seen.h == F.col("fh"))).groupBy(
        "doc_id", "t", "host").agg(F.sum("w").alias("removed_words")).select(
        F.col("doc_id").alias("ri"), F.col("t").alias("rt"), F.col("host").alias("rh"), "removed_words")
    rows = rows.drop("lines")
    out = rows.join(removed, rows.doc_id.eqNullSafe(F.col("ri")) & (rows.t == F.col("rt"))
                    & rows.host.eqNullSafe(F.col("rh")), "left")
    n, gone = F.col("n_words"), F.coalesce("removed_words", F.lit(0))
    failed = (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)
    return out.select("doc_id", *BASE, failed.alias("base_failed"), gone.alias("removed_words"),
                      (~failed & (100 * (n - gone) >= min_left * n) & (n - gone >= min_words)).alias("kept"))
