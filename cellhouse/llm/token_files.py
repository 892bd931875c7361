"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code
with separate control bytes, decoded by numpy table lookup.

Layout of an output folder::

    ranks/        one row per id in use: id, n, rank (0 = most frequent, ties by id)
    blocks/       part files in ascending document order; a file is a run of blocks

    block  = header, document table, control bytes, data bytes, line feed
    header = b"TIDB", u32 documents, u32 ids, u32 data bytes
    table  = i64 document id * documents, u8 is-null * documents, u32 ids * documents
    control byte = byte lengths less one of four ids, two bits each, low bits first
    data   = each id's rank, little-endian, in 1 to 4 bytes

Blocks are rows that Spark's text writer puts down byte for byte, so files are
committed like any Spark output (retried tasks leave no trace) on any Hadoop
file system; ``binaryFile`` reads them back.  A block holds whole documents and
about ``BLOCK_IDS`` ids, a file at most ``BLOCKS_PER_FILE`` blocks.

Passes: (1) encode each text once, store ids; (2) count ids (a row per id and
task, summed); (3) range-partition the stored ids by document id, sort, write;
(4) read back: per-file totals give each file's first position.  Only the rank
table (bounded by the vocabulary) and one number per file pass the driver.

Defined results: a null text is empty (the end id alone); documents follow in
ascending id, null ids first, rows of equal id by the first 16 bytes of their ids
(then a hash of all, so that they need not be in one task); each row is
a document of its own; an empty table gives no file rows; other columns are
ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, prepare, stored
from .tokens import encoder, id_type

BLOCK_IDS = 1 << 18
BLOCKS_PER_FILE = 64
IDS_PER_PARTITION = 1 << 23
MAGIC = b"TIDB"

# byte lengths of the four ids of each control byte, and their sum
_CODES = np.arange(256)
LENGTHS = np.stack([(_CODES >> s & 3) + 1 for s in (0, 2, 4, 6)], 1).astype(np.int64)
_MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = values.astype("<u4")
    code = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    padded = np.concatenate((code, np.zeros(-len(code) % 4, np.uint8))).reshape(-1, 4)
    control = padded[:, 0] | padded[:, 1] << 2 | padded[:, 2] << 4 | padded[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_values(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """Values from control and data bytes: lengths by table, positions by a
    running sum, then one masked 4-byte gather per value."""
    lengths = LENGTHS[control].reshape(-1)[:n]
    at = np.cumsum(lengths) - lengths
    wide = np.concatenate((data, np.zeros(4, np.uint8)))
    word = np.lib.stride_tricks.as_strided(wide, (len(data) + 1, 4), (1, 1))[at].copy().view("<u4").reshape(-1)
    return word & _MASKS[lengths - 1]


def write_block(doc_ids: list, counts: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = encode_values(ranks)
    null = np.array([d is None for d in doc_ids], np.uint8)
    ids = np.array([0 if d is None else d for d in doc_ids], "<i8")
    return b"".join((MAGIC, struct.pack("<III", len(doc_ids), len(ranks), len(data)), ids.tobytes(), null.tobytes(),
                     counts.astype("<u4").tobytes(), control, data))


def read_blocks(content: bytes, values: bool = True):
    """(document ids, null flags, counts, ranks or None) of each block of a file."""
    at, buf = 0, np.frombuffer(content, np.uint8)
    while at < len(content):
        if content[at: at + 4] != MAGIC:
            raise ValueError(f"no block at byte {at}")
        n_docs, n_ids, n_data = struct.unpack_from("<III", content, at + 4)
        at += 16
        ids = np.frombuffer(content, "<i8", n_docs, at)
        null = buf[at + 8 * n_docs: at + 9 * n_docs]
        counts = np.frombuffer(content, "<u4", n_docs, at + 9 * n_docs).astype(np.int64)
        at += 13 * n_docs
        n_control = -(-n_ids // 4)
        ranks = decode_values(buf[at: at + n_control], buf[at + n_control: at + n_control + n_data],
                              n_ids) if values else None
        at += n_control + n_data + 1
        yield ids, null, counts, ranks


def encoded(docs: DataFrame, tokenizer: str, cut: str, end_id: int, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (little-endian, of ``id_type``, the end id last), lazy."""
    prepare(docs.sparkSession)
    kind = id_type(tokenizer, end_id)

    def encode(batches):
        enc = encoder(tokenizer, cut)
        for b in batches:
            for first, run in blocks(b.column(1)):
                ids, at = enc.encode(run)
                raw = np.insert(ids.astype(kind), at[1:], end_id).tobytes()
                bounds = (int(kind[-1]) * (at + np.arange(len(at)))).tolist()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(run)),
                     pa.array([raw[i:j] for i, j in zip(bounds[:-1], bounds[1:])], pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(
        encode, "doc_id long, ids binary")


def _values(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column in one array, and the number of ids of each row."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]: at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(kind), np.diff(at) // int(kind[-1])


def rank_table(tokens: DataFrame, kind: str) -> DataFrame:
    """``id, n, rank`` over all ids; at most one row per id of the vocabulary."""

    def count(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            c = np.bincount(_values(b.column(0), kind)[0], minlength=len(total))
            c[: len(total)] += total
            total = c
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    counts = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = sorted(((r.n, r.id) for r in counts.collect()), key=lambda x: (-x[0], x[1]))  # bounded by the vocabulary
    return tokens.sparkSession.createDataFrame([(i, n, k) for k, (n, i) in enumerate(rows)],
                                               "id long, n long, rank long")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, cut: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Encode all documents and write the files described above below ``path``."""
    spark = docs.sparkSession
    kind = id_type(tokenizer, end_id)
    tokens = stored(encoded(docs, tokenizer, cut, end_id, id_col, text_col), "tokens")
    ranks = rank_table(tokens, kind)
    ranks.coalesce(1).write.parquet(f"{path}/ranks")
    rows = ranks.select("id", "n").orderBy("rank").collect()  # bounded by the vocabulary
    by_rank = [r.id for r in rows]
    lookup = np.zeros(max(by_rank, default=0) + 1, np.uint32)
    lookup[by_rank] = np.arange(len(by_rank))
    total = sum(r.n for r in rows)
    shared = spark.sparkContext.broadcast(lookup)

    def blocks_of(batches):
        to_rank = shared.value
        docs_in: list = []
        counts: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        n = 0

        def block():
            return pa.RecordBatch.from_arrays(
                [pa.array([write_block(docs_in, np.concatenate(counts), np.concatenate(parts))], pa.binary())], ["block"])

        for b in batches:
            values, sizes = _values(b.column(1), kind)
            ranked, ends, names = to_rank[values], np.cumsum(sizes), b.column(0).to_pylist()
            i = 0
            while i < len(names):  # the documents that still fit; one at least
                base = int(ends[i - 1]) if i else 0
                j = max(int(np.searchsorted(ends, base + BLOCK_IDS - n, "right")), i if n else i + 1)
                if j > i:
                    docs_in += names[i:j]
                    counts.append(sizes[i:j])
                    parts.append(ranked[base: int(ends[j - 1])])
                    n += int(ends[j - 1]) - base
                if j < len(names):
                    yield block()
                    docs_in, counts, parts, n = [], [], [], 0
                i = j
        if docs_in:
            yield block()

    n_parts = max(1, -(-total // IDS_PER_PARTITION), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # repeated rows spread over partitions too; of the ids only their beginning is sampled for the ranges
    order = ["doc_id", F.substring("ids", 1, 16), F.xxhash64("ids"), "place"]
    tokens = tokens.withColumn("place", F.monotonically_increasing_id())
    ordered = tokens.repartitionByRange(n_parts, *order).sortWithinPartitions(*order).drop("place")
    (ordered.mapInArrow(blocks_of, "block binary").select(F.col("block").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", BLOCKS_PER_FILE).text(f"{path}/blocks"))


def read_token_files(spark, path: str, with_ids: bool = False) -> DataFrame:
    """Documents from the files: ``doc_id, start, n_tokens, ids_crc32`` and, with
    ``with_ids``, ``ids``.  ``start`` counts the ids of all documents before."""
    prepare(spark)
    ranks = spark.read.schema("id long, n long, rank long").parquet(f"{path}/ranks")
    back = np.array([r.id for r in ranks.orderBy("rank").collect()], "<u4")  # bounded by the vocabulary
    shared = spark.sparkContext.broadcast(back)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/blocks")
    name = F.element_at(F.split("path", "/"), -1).alias("file")  # part number, then file number: names ascend

    def totals_of(batches):
        for b in batches:
            n = [sum(int(c.sum()) for _, _, c, _ in read_blocks(x.as_py(), False)) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["file", "n"])

    order = F.struct(F.regexp_extract("file", r"part-(\d+)", 1).cast("long"),
                     F.regexp_extract("file", r"-c(\d+)", 1).cast("long"))
    totals = files.select(name, "content").mapInArrow(totals_of, "file string, n long")
    rows = totals.withColumn("o", order).collect()  # one number per file
    first, sofar = [], 0
    for r in sorted(rows, key=lambda r: tuple(r.o)):
        first.append((r.file, sofar))
        sofar += r.n

    def documents_of(batches):
        to_id = shared.value
        for b in batches:
            for file, x in zip(b.column(0), b.column(1)):
                base = 0
                for ids, null, counts, ranks in read_blocks(x.as_py()):
                    raw = to_id[ranks].tobytes()
                    upto = np.concatenate(([0], np.cumsum(counts)))
                    bounds = (4 * upto).tolist()
                    parts = [raw[i:j] for i, j in zip(bounds[:-1], bounds[1:])]
                    cols = [pa.array([file.as_py()] * len(ids), pa.string()), pa.array(ids, pa.int64(), mask=null > 0),
                            pa.array(base + upto[:-1], pa.int64()), pa.array(counts, pa.int64()),
                            pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                    names = ["file", "doc_id", "within", "n_tokens", "ids_crc32"]
                    if with_ids:
                        cols.append(pa.array(parts, pa.binary()))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(cols, names)
                    base += int(upto[-1])

    schema = "file string, doc_id long, within long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    docs = files.select(name, "content").mapInArrow(documents_of, schema)
    at = spark.createDataFrame(first, "file string, first long")
    out = docs.join(at, "file").withColumn("start", F.col("first") + F.col("within"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
