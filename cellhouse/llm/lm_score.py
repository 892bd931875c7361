"""Stupid-backoff language-model scores, computed relationally.

    S(w | h) = f(h w) / f(h)      if f(h w) >= MIN_COUNT
             = BACKOFF * S(w | h without its first word)   otherwise
    S(w)     = f(w) / N

f counts n-grams over all documents, N all words.  A document's score is the
sum of log S over its words.

Plan: documents are dealt by hash into batches of bounded bytes.  A batch's
n-grams are exploded and pre-aggregated (hash, count) and go, cut by hash range
into buckets, to the count tables; there the counts of all batches meet and are
summed, and each batch's n-grams are joined to the totals; what the totals have
beyond the batch's own counts goes back to it, in the order of its own sorted
hashes.  Words and pairs go first.  Of a longer n-gram a batch asks only if both
n-grams one word shorter in it occur in other batches too: else all of its own
occurrences are in the batch, and its count is the total already (exact, and most
n-grams of three words need not be asked).  At last scores are summed per document.
So an n-gram crosses the network at most once per batch, as about 6 bytes, and its
total comes back as a bit or a byte.  A word in every document is one row per batch:
no key is hot.  Both sides' groups are bounded (BATCH_BYTES of text; BUCKET_BYTES of
text's worth of n-grams).  A batch's n-grams are cut into ``FAN`` buckets at most; where
the corpus needs more, the requests of ``FAN`` batches to a bucket are merged first and
the merged ones cut finer, and so on, so a request keeps thousands of hashes.

``score_by_joins`` is the same as plain joins of exploded n-grams with
``count_tables``, for corpora where a row per n-gram occurrence is no matter; tests
hold the two against each other.

Words are those of the benchmark check: runs of letters, digits and bytes beyond
ASCII, A-Z lower-cased.  N-grams are told apart by a 64-bit hash.

Defined results: null, empty and wordless texts have no words, score 0 and a
null mean; repeated rows count each and get a row each; null ids are kept;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, per_text, prepare, stored, window_hashes
from .decontaminate import words_of
from .token_files import decode_values, encode_values

ORDER, BACKOFF, MIN_COUNT = 3, 0.4, 1
AT_ONCE = 2  # orders that are asked without looking at shorter n-grams
BATCH_BYTES, BUCKET_BYTES = 12 << 20, 8 << 20
FAN = 1024  # buckets that a batch's n-grams are cut into at most


def pack_counts(n: np.ndarray, usual: int) -> bytes:
    """Counts of which most are ``usual``: a bit each, and the others in the code of
    the token files (whole if one needs over 32 bits)."""
    other = n != usual
    rest, bits = n[other], np.packbits(other).tobytes()
    if len(rest) and int(rest.max()) >= 1 << 32:
        return b"\1" + bits + rest.astype("<u8").tobytes()
    control, data = encode_values(rest)
    return b"\0" + bits + control + data


def unpack_counts(raw: bytes, n: int, usual: int) -> np.ndarray:
    buf, k = np.frombuffer(raw, np.uint8, -1, 1), -(-n // 8)
    other = np.unpackbits(buf[:k], count=n).astype(bool)
    out, m = np.full(n, usual, np.int64), int(other.sum())
    if raw[:1] == b"\1":
        out[other] = np.frombuffer(raw, "<u8", m, 1 + k)
    else:
        c = k + -(-m // 4)
        out[other] = decode_values(buf[k:c], buf[c:], m)
    return out


def pack_hashes(h: np.ndarray) -> bytes:
    """Ascending hashes as differences of as few bytes as the largest needs."""
    d = np.diff(h, prepend=np.uint64(0))
    width = max(1, (int(d[1:].max()).bit_length() + 7) // 8) if len(d) > 1 else 1
    return (bytes([width]) + h[:1].astype("<u8").tobytes()
            + d[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes())


def unpack_hashes(raw: bytes, n: int) -> np.ndarray:
    width = raw[0]
    d = np.zeros((n, 8), np.uint8)
    d[0] = np.frombuffer(raw, np.uint8, 8, 1)
    d[1:, :width] = np.frombuffer(raw, np.uint8, (n - 1) * width, 9).reshape(-1, width)
    return np.cumsum(d.view("<u8").reshape(-1), dtype=np.uint64)


class Batch:
    """N-grams of a batch of texts: for each order the hashes at every place
    where one begins (inside one text), sorted and distinct."""

    def __init__(self, texts: pa.ChunkedArray, order: int):
        run = texts.combine_chunks().cast(pa.large_string()).fill_null("")
        if isinstance(run, pa.ChunkedArray):
            run = run.chunk(0) if run.num_chunks else pa.array([], pa.large_string())
        _, _, _, h, self.bounds = words_of(run)
        self.n = np.diff(self.bounds)
        text = np.repeat(np.arange(len(self.n)), self.n)
        self.place = np.arange(len(h)) - np.repeat(self.bounds[:-1], self.n)
        self.at, self.grams, self.index, self.counts = [], [], [], []
        for k in range(1, order + 1):
            g = window_hashes(h, k)
            at = np.flatnonzero(text[: len(g)] == text[k - 1:][: len(g)])
            u, back, n = np.unique(g[at], return_inverse=True, return_counts=True)
            self.at.append(at.astype(np.int32))  # a batch has less than 2 ** 31 words
            self.grams.append(u)
            self.index.append(back.astype(np.int32))
            self.counts.append(n.astype(np.int32))


def _edges(n_buckets: int) -> np.ndarray:
    width = -(-(1 << 64) // n_buckets)  # hashes of a bucket
    return np.array([i * width for i in range(1, n_buckets) if i * width < 1 << 64], np.uint64)


def _asked(b: Batch, k: int, totals: np.ndarray) -> np.ndarray:
    """Which of the batch's distinct n-grams of ``k`` words may occur in other batches:
    those whose n-grams of ``k - 1`` words (``totals``) both do."""
    elsewhere = totals > b.counts[k - 2]
    at = np.zeros(len(b.place) + 1, np.int64)
    at[b.at[k - 2]] = b.index[k - 2]
    first = b.at[k - 1]
    out = np.zeros(len(b.grams[k - 1]), bool)
    out[b.index[k - 1]] = elsewhere[at[first]] & elsewhere[at[first + 1]] if len(first) else False
    return out


def _known(b: Batch, answers: pa.Table, order: int) -> list[np.ndarray]:
    """Totals of the batch's distinct n-grams of 1 to ``order`` words."""
    ks, buckets = answers.column("k").to_numpy(), answers.column("bucket").to_numpy()
    sizes, packed = answers.column("n").to_numpy(), answers.column("beyond")
    out: list[np.ndarray] = []
    for k in range(1, order + 1):
        rows = np.flatnonzero(ks == k)
        rows = rows[np.argsort(buckets[rows], kind="stable")]
        beyond = np.concatenate([np.zeros(0, np.int64),
                                 *(unpack_counts(packed[r].as_py(), int(sizes[r]), 0) for r in rows.tolist())])
        total = b.counts[k - 1].astype(np.int64)
        total[slice(None) if k <= AT_ONCE else _asked(b, k, out[-1])] += beyond
        out.append(total)
    return out


_REQUESTS = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("k", pa.int32()), ("n", pa.int64()),
                       ("hashes", pa.binary()), ("counts", pa.binary())])


_ANSWERS = pa.schema([("batch", pa.int64()), ("k", pa.int32()), ("bucket", pa.int64()), ("n", pa.int64()),
                      ("beyond", pa.binary())])
_REQUEST = "bucket long, batch long, k int, n long, hashes binary, counts binary"
_ANSWER = "batch long, k int, bucket long, n long, beyond binary"


def _request_rows(batch: int, wanted: list[tuple[int, np.ndarray, np.ndarray]], edges: np.ndarray) -> pa.Table:
    out = {name: [] for name in _REQUESTS.names}
    for k, u, n in wanted:
        cut = np.concatenate(([0], np.searchsorted(u, edges), [len(u)]))
        for bucket in np.flatnonzero(np.diff(cut)).tolist():
            i, j = cut[bucket], cut[bucket + 1]
            for name, v in zip(out, (bucket, batch, k, int(j - i), pack_hashes(u[i:j]), pack_counts(n[i:j], 1))):
                out[name].append(v)
    return pa.table(out, schema=_REQUESTS)


def _requests(n_buckets: int, order: int):
    edges = _edges(n_buckets)

    def requests(table: pa.Table) -> pa.Table:
        b = Batch(table.column("text"), order)
        return _request_rows(table.column("batch")[0].as_py(),
                             [(k, u, n) for k, (u, n) in enumerate(zip(b.grams, b.counts), 1)], edges)

    return requests


def _longer_requests(n_buckets: int, k: int):
    edges = _edges(n_buckets)

    def requests(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return _REQUESTS.empty_table()
        b = Batch(docs.column("text"), k)
        some = _asked(b, k, _known(b, answers, k - 1)[-1])
        return _request_rows(docs.column("batch")[0].as_py(), [(k, b.grams[k - 1][some], b.counts[k - 1][some])], edges)

    return requests


def _merge(table: pa.Table):
    """For each order: (hashes, totals, place of each request's hashes among them,
    rows of the requests, their sizes); before the places, the requests' own counts."""
    ks = table.column("k").to_numpy()
    sizes = table.column("n").to_numpy()
    hashes, counts = table.column("hashes"), table.column("counts")
    for k in np.unique(ks).tolist():
        rows = np.flatnonzero(ks == k)
        h = np.concatenate([unpack_hashes(hashes[r].as_py(), int(sizes[r])) for r in rows.tolist()])
        n = np.concatenate([unpack_counts(counts[r].as_py(), int(sizes[r]), 1) for r in rows.tolist()])
        order = np.argsort(h, kind="stable")
        s = h[order]
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        totals = np.add.reduceat(n[order], np.flatnonzero(new))
        back = np.empty(len(s), np.int64)
        back[order] = np.cumsum(new) - 1
        yield k, s[new], totals, n, back, rows, sizes[rows]


def _answers(table: pa.Table) -> pa.Table:
    batch, bucket = table.column("batch").to_numpy(), table.column("bucket")[0].as_py()
    out = {"batch": [], "k": [], "bucket": [], "n": [], "beyond": []}
    for k, _, totals, own, back, rows, sizes in _merge(table):
        ends = np.cumsum(sizes)
        for r, a, b in zip(rows.tolist(), (ends - sizes).tolist(), ends.tolist()):
            for name, v in zip(out, (int(batch[r]), k, bucket, b - a, pack_counts(totals[back[a:b]] - own[a:b], 0))):
                out[name].append(v)
    return pa.table(out, schema=_ANSWERS)


def _merged_requests(n_buckets: int, n_groups: int):
    """The requests of a group of batches to one bucket as one, cut finer."""
    edges = _edges(n_buckets)

    def requests(table: pa.Table) -> pa.Table:
        asker = table.column("bucket")[0].as_py() * n_groups + table.column("group")[0].as_py()
        return _request_rows(asker, [(k, h, totals) for k, h, totals, *_ in _merge(table)], edges)

    return requests


def _passed_on(table: pa.Table, answers: pa.Table) -> pa.Table:
    """Answers to a group's single requests from those to its merged one."""
    batch, out = table.column("batch").to_numpy(), {name: [] for name in _ANSWERS.names}
    ks, buckets = answers.column("k").to_numpy(), answers.column("bucket").to_numpy()
    sizes, packed = answers.column("n").to_numpy(), answers.column("beyond")
    for k, _, totals, own, back, rows, lens in _merge(table):
        at = np.flatnonzero(ks == k)
        at = at[np.argsort(buckets[at], kind="stable")]
        whole = totals + np.concatenate([unpack_counts(packed[r].as_py(), int(sizes[r]), 0) for r in at.tolist()])
        ends = np.cumsum(lens)
        for r, a, b in zip(rows.tolist(), (ends - lens).tolist(), ends.tolist()):
            bucket = table.column("bucket")[r].as_py()
            for name, v in zip(out, (int(batch[r]), k, bucket, b - a, pack_counts(whole[back[a:b]] - own[a:b], 0))):
                out[name].append(v)
    return pa.table(out, schema=_ANSWERS)


def _told(asked: DataFrame, n_askers: int, n_cut: int, n_buckets: int) -> DataFrame:
    """Answers to requests that are cut into ``n_cut`` buckets, where ``n_buckets`` are
    wanted: by the buckets themselves if they are as many, else by way of merged requests."""
    if n_cut >= n_buckets:
        return asked.groupBy("bucket").applyInArrow(_answers, _ANSWER)
    fan, finer = FAN, min(n_buckets, n_cut * FAN)
    n_groups = -(-n_askers // fan)
    asked = asked.withColumn("group", F.floor(F.col("batch") / fan))
    merged = asked.groupBy("bucket", "group").applyInArrow(_merged_requests(finer, n_groups), _REQUEST)
    told = _told(merged, n_cut * n_groups, finer, n_buckets).withColumns({
        "b": F.floor(F.col("batch") / n_groups), "g": F.col("batch") % n_groups})
    return asked.groupBy("bucket", "group").cogroup(told.groupBy("b", "g")).applyInArrow(_passed_on, _ANSWER)


def _counts(min_count: int):
    def counts(table: pa.Table) -> pa.Table:
        parts = [pa.table({"k": pa.array(np.full(len(h), k), pa.int32()), "hash": pa.array(h.view(np.int64)),
                           "n": pa.array(n, pa.int64())}).filter(pa.array(n >= min_count))
                 for k, h, n, *_ in _merge(table)]
        return pa.concat_tables(parts)

    return counts


def _scores(order: int, backoff: float, min_count: int):
    def scores(docs: pa.Table, answers: pa.Table) -> pa.Table:
        b = Batch(docs.column("text"), order)
        f = []  # count of the n-gram of each order that ends at each place; 0: there is none
        for k, total in enumerate(_known(b, answers, order), 1):
            at_end = np.zeros(len(b.place), np.int64)
            at_end[b.at[k - 1] + k - 1] = total[b.index[k - 1]]
            f.append(at_end)
        log = np.zeros(len(b.place))
        open_, unigrams = np.ones(len(log), bool), np.zeros(len(log), bool)
        start = np.minimum(order, b.place + 1)
        for k in range(order, 0, -1):
            use = open_ & (f[k - 1] >= (min_count if k > 1 else 1))
            i = np.flatnonzero(use)
            log[i] = np.log(f[k - 1][i]) + (start[i] - k) * np.log(backoff)
            if k > 1:
                log[i] -= np.log(f[k - 2][i - 1])
            else:
                unigrams[i] = True
            open_[i] = False
        c = np.concatenate(([0.0], np.cumsum(log)))
        part = np.add.reduceat(np.append(log, 0.0), np.minimum(b.bounds[:-1], len(log))) if len(b.n) else c[:0]
        return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(b.n, pa.int64()),
                         "n_unigram": pa.array(per_text(unigrams, b.bounds), pa.int64()),
                         "part": pa.array(np.where(b.n > 0, part, 0.0), pa.float64())})

    return scores


def _dealt(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int, int]:
    """(doc_id, text, batch) and the numbers of batches and buckets, by the bytes of all texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // BATCH_BYTES))
    # with the row's place, so that repeated rows spread (the same each time a stored table is scanned)
    return (rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(n))),
            n, max(1, -(-total // BUCKET_BYTES)))


def count_tables(docs: DataFrame, order: int = ORDER, min_count: int = 1, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``k, hash, n``: the n-gram counts over all documents, partitioned by hash."""
    prepare(docs.sparkSession)
    rows, _, n_buckets = _dealt(docs, id_col, text_col)
    asked = rows.groupBy("batch").applyInArrow(_requests(n_buckets, order), _REQUEST)
    return asked.groupBy("bucket").applyInArrow(_counts(min_count), "k int, hash long, n long")


def score(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, min_count: int = MIN_COUNT,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, log_score, mean_log_score`` of every row."""
    prepare(docs.sparkSession)
    rows, n_batches, n_buckets = _dealt(docs, id_col, text_col)
    n_cut = min(n_buckets, FAN)
    asked = rows.groupBy("batch").applyInArrow(_requests(n_cut, min(order, AT_ONCE)), _REQUEST)
    told = _told(asked, n_batches, n_cut, n_buckets)
    for k in range(AT_ONCE + 1, order + 1):  # all in one plan: the batches are shuffled once and read by each round
        more = rows.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(_longer_requests(n_cut, k), _REQUEST)
        told = told.union(_told(more, n_batches, n_cut, n_buckets))
    parts = rows.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(
        _scores(order, backoff, min_count), "doc_id long, n_words long, n_unigram long, part double")
    parts = stored(parts, "lm-parts")
    return _whole(parts)


def _whole(parts: DataFrame) -> DataFrame:
    total = parts.agg(F.sum("n_words")).first()[0] or 0
    log_n = float(np.log(max(1, total)))
    out = parts.withColumn("log_score", F.col("part") - F.col("n_unigram") * F.lit(log_n))
    return out.select("doc_id", "n_words", "log_score",
                      F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("mean_log_score"))


def ngrams(rows: DataFrame, order: int) -> DataFrame:
    """``row, place, k, hash``: the n-gram of each order that ends at each word of
    ``rows`` (``row long, text``)."""
    def explode(batches):
        for b in batches:
            for first, run in blocks(b.column(1)):
                grams = Batch(pa.chunked_array([run]), order)
                ids = b.column(0).slice(first, len(run))
                text = np.repeat(np.arange(len(run)), grams.n)
                for k in range(1, order + 1):
                    end = grams.at[k - 1] + k - 1
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(text[end])), pa.array(grams.place[end]), pa.array(np.full(len(end), k), pa.int32()),
                         pa.array(grams.grams[k - 1][grams.index[k - 1]].view(np.int64))], ["row", "place", "k", "hash"])

    return rows.mapInArrow(explode, "row long, place long, k int, hash long")


def score_by_joins(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, min_count: int = MIN_COUNT,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score`` as joins: every n-gram occurrence is a row, joined to ``count_tables``
    (itself, for n-grams seen ``min_count`` times, and its history) and summed."""
    prepare(docs.sparkSession)
    rows = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                              F.monotonically_increasing_id().alias("row")), "lm-rows")
    counts = stored(count_tables(rows, order), "lm-counts")
    grams = stored(ngrams(rows.select("row", "text"), order).join(counts, ["k", "hash"]), "lm-ngrams")
    history = grams.select("row", (F.col("place") + 1).alias("place"), (F.col("k") + 1).alias("k"), F.col("n").alias("h"))
    used = grams.where((F.col("k") == 1) | (F.col("n") >= min_count)).join(history, ["row", "place", "k"], "left")
    best = used.groupBy("row", "place").agg(F.max_by(F.struct("k", "n", "h"), "k").alias("b"))
    start = F.least(F.lit(order), F.col("place") + 1)
    log = F.ln("b.n") + (start - F.col("b.k")) * F.lit(float(np.log(backoff))) - F.when(
        F.col("b.k") > 1, F.ln("b.h")).otherwise(0.0)
    sums = best.groupBy("row").agg(F.count("*").alias("n_words"), F.count_if(F.col("b.k") == 1).alias("n_unigram"),
                                   F.sum(log).alias("part"))
    return _whole(rows.select("row", "doc_id").join(sums, "row", "left").select(
        "doc_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_words", "n_unigram")),
        F.coalesce("part", F.lit(0.0)).alias("part")))
