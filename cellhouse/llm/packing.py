"""Packing: best-fit decreasing with a segment tree over remaining capacity.

1. ``tokenised_pieces`` encodes whole documents (plus the end id) and cuts them
   into full windows and one remainder.  Rows are written once to the shared
   folder; they hold offsets and checksums, and the ids if ``with_ids``.
2. ``pack`` deals the pieces into shards of about ``PIECES_PER_SHARD`` by hash,
   sorts each shard by falling length inside its task and places each piece in
   the open sequence with the least remaining capacity that still holds it (a
   segment tree over the capacities 0..window finds it in log(window) steps).
   A shard leaves at most about half a window open, one part in some thousands.

Memory of a task: one text block of ids, and the open sequences of one shard.

Defined results: a null text is an empty one and gives the end id alone; a
document of any length is cut into full windows, its last piece packed with
others; rows with equal ids, repeated rows and null ids are documents of their
own; an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, prepare, stored
from .tokens import encoder

WINDOW = 2048
PIECES_PER_SHARD = 4096

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def tokenised_pieces(docs: DataFrame, tokenizer: str, cut: str, end_id: int, window: int = WINDOW,
                     with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of every document (lazy): full windows first, then the
    remainder.  ``with_ids`` adds ``ids`` (little-endian unsigned 32-bit)."""
    prepare(docs.sparkSession)

    def cut_documents(batches):
        enc = encoder(tokenizer, cut)
        for b in batches:
            row_ids = b.column(0)
            for first, run in blocks(b.column(1)):
                ids, at = enc.encode(run)
                n = np.diff(at) + 1
                pieces = -(-n // window)
                doc = np.repeat(np.arange(len(n)), pieces)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
                length = np.minimum(window, n[doc] - start)
                ids = np.insert(ids.astype("<u4"), at[1:], end_id)
                begin = (at[:-1] + np.arange(len(n)))[doc] + start
                raw = ids.tobytes()
                parts = [raw[4 * a: 4 * (a + k)] for a, k in zip(begin.tolist(), length.tolist())]
                cols = [row_ids.slice(first, len(run)).take(pa.array(doc)), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                        pa.array(n[doc], pa.int64())]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    cols.append(pa.array(parts, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = PIECE_SCHEMA + (", ids binary" if with_ids else "")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(cut_documents, schema)


class BestFit:
    """Open sequences by remaining capacity.  ``tree`` is a segment tree over
    the capacities: a node holds how many open sequences lie below it."""

    def __init__(self, window: int):
        self.window = window
        self.leaves = 1 << window.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]
        self.n = 0

    def _add(self, capacity: int, by: int):
        i = capacity + self.leaves
        while i:
            self.tree[i] += by
            i >>= 1

    def tightest(self, length: int) -> int:
        """Least capacity >= length of an open sequence; -1 if there is none."""
        i, tree = length + self.leaves, self.tree
        while not tree[i]:
            while i & 1:  # a right child: what lies right of it is right of its parent
                i >>= 1
            if not i:
                return -1
            i += 1
        while i < self.leaves:
            i = 2 * i if tree[2 * i] else 2 * i + 1
        return i - self.leaves

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece; opens a sequence if none holds it."""
        c = self.tightest(length) if self.n else -1
        if c < 0:
            c, seq = self.window, self.n
            self.n += 1
        else:
            seq = self.open[c].pop()
            self._add(c, -1)
        if c > length:
            self.open[c - length].append(seq)
            self._add(c - length, 1)
        return seq, self.window - c


def pack(pieces: DataFrame, window: int = WINDOW, per_shard: int = PIECES_PER_SHARD) -> DataFrame:
    """``pieces`` (a stored table with ``doc_id, start, length, ids_crc32``, any
    further columns are kept) with ``sequence_id`` and ``offset``.  Lengths lie
    between 1 and ``window``."""
    prepare(pieces.sparkSession)
    n_shards = max(1, -(-pieces.count() // per_shard))
    # with the row's place, so that repeated rows spread
    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()),
                                               F.lit(n_shards)))
    dealt = dealt.repartition("_shard").sortWithinPartitions(
        "_shard", F.desc("length"), "doc_id", "start", "ids_crc32")
    names = [c for c in dealt.columns if c != "_shard"]

    def best_fit(batches):
        shard, bins = None, None
        for b in batches:
            seqs, offsets = [], []
            for s, length in zip(b.column("_shard").to_pylist(), b.column("length").to_pylist()):
                if s != shard:
                    shard, bins = s, BestFit(window)
                seq, at = bins.place(length)
                seqs.append((s << 32) | seq)
                offsets.append(at)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in names] + [pa.array(seqs, pa.int64()), pa.array(offsets, pa.int64())],
                names + ["sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema if f.name != "_shard")
    return dealt.mapInArrow(best_fit, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, cut: str, end_id: int, window: int = WINDOW,
                   with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents: one row per piece with its sequence and offset."""
    pieces = tokenised_pieces(docs, tokenizer, cut, end_id, window, with_ids, id_col, text_col)
    return pack(stored(pieces, "pieces"), window)


def sequences(packed: DataFrame, pad_id: int = 0, window: int = WINDOW) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, n_tokens, ids`` with the
    ids of all pieces in offset order, padded to the window (a sequence that
    ends at a power of two needs no padding).  Needs ``ids`` in ``packed``; a
    sequence is a bounded group of at most ``window`` pieces."""
    whole = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("n_tokens"))
    ids = F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    pad = F.repeat(F.lit(f"{int.from_bytes(pad_id.to_bytes(4, 'little'), 'big'):08x}"),
                   (F.lit(window) - F.col("n_tokens")).cast("int"))
    exact = F.bit_count("n_tokens") == 1
    return whole.select("sequence_id", "n_tokens",
                        F.when(exact, ids).otherwise(F.concat(ids, F.unhex(pad))).alias("ids"))
