"""Token files, packing, decontamination and LM scoring against brute force."""

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import brute
from cellhouse.llm import decontaminate, lm_score, packing, token_files
from cellhouse.llm.common import stored, table
from cellhouse.llm.tokens import BYTE_LEVEL, WORD_END, TextEncoder
from cellhouse.session import new_path

SF = "/root/testdata/sf0.001"
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "  ", " a  b", "It's.they'll, I'd!No", "a.b.c ,d", "x\t y  z  \n\n w ", "É Σας ΣΑΣ. İx y",
       "<|endoftext|> a<|endoftext|>b", "1,000.5 a1.b2!", "foo#.bar", "\n\nA\n", "日本語。テスト a", "é .", "'S 'LL",
       "\x1c a\x1cb !\x1c!", "don't.Can't!,'s", "a  b c\x85 d", "A.!B,c.D"]


def direct(path, texts, end):
    tok = Tokenizer.from_file(path)
    return [e.ids + [end] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def docs_of(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    return rows + [r[:2] for r in brute.edge_rows()]


def both(spark):
    return table(spark, SF, "documents").select("doc_id", "text").union(brute.edge(spark).select("doc_id", "text"))


@pytest.mark.parametrize("path, cut", [(BYTE, BYTE_LEVEL), (WORD, WORD_END)])
def test_word_table_equals_direct_encoding(spark, path, cut):
    texts = ODD + [t or "" for _, t in docs_of(spark)]
    enc = TextEncoder(path, cut, table_words=500)  # forgets many times
    for i in range(0, len(texts), 10):
        ids, at = enc.encode(texts[i:i + 10])
        want = [x[:-1] for x in direct(path, texts[i:i + 10], 0)]
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


PARTS = ["a", "B", "é", "İ", "i̇", "ſ", "Σ", "ς", "क़", "क", "़", "יִ", "1", "²", "½", "Ⅷ", "日", "。", "-", "_", "'s", "'ll",
         "'T", '"', "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|end", "\x01", "\t", "\r", "\x85", "\xa0",
         "\u2003", "\x1c", "\u200b", " ", " ", "  ", "\n", "\n\n", ".", ",", "!", "?", ".,", " .", " ,", "word", "Word.",
         "x,y", "K", "ﬁ", "\u0301", "😀", "Ⰰ", "ꙮ", "Ж", "ΑΣ", "ǅ", "a.b", "힣"]


@pytest.mark.parametrize("path, cut", [(BYTE, BYTE_LEVEL), (WORD, WORD_END)])
def test_word_table_on_random_strings(path, cut):
    r = np.random.default_rng(7)
    enc = TextEncoder(path, cut, table_words=3000)
    for _ in range(100):
        texts = ["".join(PARTS[k] + " " * int(r.random() < 0.3) for k in r.integers(0, len(PARTS), n))
                 for n in r.integers(0, 8, 500)]
        ids, at = enc.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [x[:-1] for x in direct(path, texts, 0)]


def test_slices_of_columns_are_encoded_alike():
    texts = ["Ünïcödé, Text. " * k for k in range(1, 40)] + ["A  b\n c", "", "İ, x", "<|endoftext|>"] * 5
    column = pa.array(texts, pa.string())
    for path, cut in ((BYTE, BYTE_LEVEL), (WORD, WORD_END)):
        want = [x[:-1] for x in direct(path, texts, 0)]
        for lo, n in ((0, 59), (1, 10), (17, 42), (40, 19)):
            for part in (column.slice(lo, n), column.slice(lo, n).cast(pa.large_string()),
                         column.cast(pa.large_string()).slice(lo, n)):
                ids, at = TextEncoder(path, cut).encode(part)
                assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want[lo:lo + n]


def test_quoted_added_tokens_are_one_id():
    for path, cut, marker in ((BYTE, BYTE_LEVEL, 50256), (WORD, WORD_END, 49407)):
        ids, _ = TextEncoder(path, cut).encode(["a <|endoftext|> b"])
        assert ids.tolist().count(marker) == 1


def test_value_code_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (r.integers(0, 1 << 32, n, dtype=np.uint64) >> r.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        control, data = token_files.encode_values(v)
        assert len(control) == -(-n // 4)
        back = token_files.decode_values(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n)
        assert (back == v).all()


def test_token_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 5000)
    path = new_path(spark, "files")
    token_files.write_token_files(both(spark), path, BYTE, BYTE_LEVEL, 2)
    rows = docs_of(spark)
    ids = direct(BYTE, [t for _, t in rows], 2)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0,
                                                    np.array(ids[i], "<u2").tobytes()))
    want, start = [], 0
    for i in order:
        want.append((rows[i][0], start, len(ids[i]), brute.crc_ids(ids[i])))
        start += len(ids[i])
    out = token_files.read_token_files(spark, path, with_ids=True)
    assert brute.rows_of(out, "doc_id", "start", "n_tokens", "ids_crc32") == brute.ordered(want)
    got = {r.start: np.frombuffer(r.ids, "<u4").tolist() for r in out.collect()}
    assert [got[w[1]] for w in want] == [ids[i] for i in order]
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert [r.n for r in ranks] == sorted((r.n for r in ranks), reverse=True)


def test_token_files_of_no_documents(spark):
    path = new_path(spark, "files")
    token_files.write_token_files(brute.none(spark), path, BYTE, BYTE_LEVEL, 2)
    assert token_files.read_token_files(spark, path).count() == 0


def test_best_fit_takes_the_tightest_open_sequence():
    r = np.random.default_rng(3)
    lengths = sorted(r.integers(1, 65, 400).tolist(), reverse=True)
    bins, left = packing.BestFit(64), []
    for n in lengths:
        seq, at = bins.place(n)
        fits = [c for c in left if c >= n]
        if fits:
            assert left[seq] == min(fits) and at == 64 - left[seq]
        else:
            assert seq == len(left) and at == 0
            left.append(64)
        left[seq] -= n


def test_packing_keeps_every_id_once(spark):
    packed = packing.pack_documents(both(spark), WORD, WORD_END, 1, window=256)
    rows = docs_of(spark)
    ids = direct(WORD, [t for _, t in rows], 1)
    want = [(d, s, min(256, len(x) - s), brute.crc_ids(x[s:s + 256]), len(x))
            for (d, _), x in zip(rows, ids) for s in range(0, len(x), 256)]
    assert brute.rows_of(packed, "doc_id", "start", "length", "ids_crc32", "doc_tokens") == brute.ordered(want)
    seqs = {}
    for r in packed.collect():
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length, bytes(r.ids)))
    for pieces in seqs.values():
        at = 0
        for offset, length, raw in sorted(pieces):
            assert offset == at and len(raw) == 4 * length
            at += length
        assert at <= 256
    assert sum(len(x) for x in ids) / (256 * len(seqs)) > 0.95
    whole = {r.sequence_id: r for r in packing.sequences(packed, pad_id=9, window=256).collect()}
    assert set(whole) == set(seqs)
    for k, r in whole.items():
        body = b"".join(raw for _, _, raw in sorted(seqs[k]))
        n = len(body) // 4
        pad = 0 if n & (n - 1) == 0 else 256 - n
        assert bytes(r.ids) == body + np.full(pad, 9, "<u4").tobytes()


def test_packing_of_no_documents(spark):
    assert packing.pack_documents(brute.none(spark), WORD, WORD_END, 1).count() == 0


ITEMS = [(1, brute.prose(40, 50)), (2, brute.prose(13, 51)), (3, "Seven words are not a whole window"), (4, "one"),
         (5, None), (6, ""), (None, brute.prose(20, 52)), (2, brute.prose(13, 51)), (7, "same " * 30),
         (10, brute.prose(40, 50)), (8, "!!!"), (11, "tick tock " * 2000), (12, "Tick, " * 4000)]


def contaminated_docs():
    a, b = brute.prose(40, 50).split(), brute.prose(13, 51).split()
    pad = brute.prose(300, 60)
    return [(100, " ".join(a[5:25])), (101, pad + " " + " ".join(a[3:16]) + " " + pad), (102, " ".join(a[3:15])),
            (103, " ".join(b)), (104, " ".join(b[:12])), (105, "SEVEN words, are not a whole window"), (106, "one"),
            (107, "Seven words are not a whole"), (108, "same " * 40), (109, "same " * 12), (110, pad + " one"),
            (111, " ".join(a[:14] + ["zz"] + a[15:30])), (112, " ".join(a + a)), (113, "tick tock " * 3000), (114, "tick " * 5000)]


@pytest.mark.parametrize("part_bytes", [decontaminate.PART_BYTES, 20_000])
def test_contamination(spark, part_bytes):
    rows = docs_of(spark) + contaminated_docs()
    docs = both(spark).union(spark.createDataFrame(contaminated_docs(), "doc_id long, text string"))
    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()] + ITEMS
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = decontaminate.find_hits(docs, items, part_bytes=part_bytes)
    want = brute.contamination(rows, bench)
    assert any(w[5] for w in want)
    assert brute.rows_of(got.drop("hits"), *[c for c in got.columns if c != "hits"]) == brute.ordered(want)


def test_contaminated_documents_go_and_columns_stay(spark):
    docs = brute.edge(spark)
    items = spark.createDataFrame([(1, brute.prose(60, 1)), (2, brute.prose(40, 2))], "item_id long, text string")
    kept = decontaminate.without_contaminated(docs, items, part_bytes=100)
    want = [r for r, c in zip(brute.edge_rows(), brute.contamination([r[:2] for r in brute.edge_rows()], [
        (1, brute.prose(60, 1)), (2, brute.prose(40, 2))])) if not c[5]]
    assert kept.schema == docs.schema and brute.rows_of(kept, *kept.columns) == brute.ordered(want)
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.without_contaminated(docs, nothing).count() == docs.count()
    assert decontaminate.find_hits(brute.none(spark), items).count() == 0
    assert decontaminate.find_hits(docs, nothing).where("n_hit > 0 or contaminated").count() == 0


def test_hits_of_several_parts_are_united_before_a_document_goes(spark):
    bench = [(i, brute.prose(15, 70 + i)) for i in range(6)]
    items = spark.createDataFrame(bench, "item_id long, text string")
    _, parts = decontaminate.benchmark_parts(items, 100)
    words = brute.prose(900, 80).split()
    text = " ".join(w for i, (_, t) in enumerate(bench) for w in [*words[150 * i:150 * i + 150], t])
    alone = [brute.contamination([(1, text)], p.value)[0] for _, p in parts]
    assert sum(a[2] > 0 for a in alone) > 1 and not any(a[5] for a in alone)  # no part alone has 5 %
    rows = [(1, text, 5), (None, text, 6), (1, " ".join(words), 7), (None, None, 8), (2, text, 9), (2, text, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _t int")
    kept = decontaminate.without_contaminated(docs, items, part_bytes=100)
    assert kept.schema == docs.schema and brute.rows_of(kept, *kept.columns) == brute.ordered([rows[2], rows[3]])
    assert decontaminate.find_hits(docs, items, part_bytes=100).where("contaminated").count() == 4


@pytest.mark.parametrize("order, batch, min_count", [(3, lm_score.BATCH_BYTES, 1), (3, 60_000, 1), (4, 60_000, 2), (1, 60_000, 1)])
def test_lm_scores(spark, monkeypatch, order, batch, min_count):
    monkeypatch.setattr(lm_score, "BATCH_BYTES", batch)
    monkeypatch.setattr(lm_score, "BUCKET_BYTES", batch // 2)
    docs = stored(both(spark), "both")
    got = brute.rows_of(lm_score.score(docs, order=order, min_count=min_count), *LM)
    want = brute.ordered(brute.lm(docs_of(spark), order, min_count=min_count))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert abs(g[2] - w[2]) < 1e-6 * max(1, abs(w[2]))
        assert (g[3] is None) == (w[1] == 0)


LM = ("doc_id", "n_words", "log_score", "mean_log_score")


def test_lm_scores_by_joins(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BATCH_BYTES", 60_000)
    docs = stored(both(spark), "both")
    for order, min_count in ((3, 1), (3, 2)):
        a, b = (brute.rows_of(f(docs, order=order, min_count=min_count), *LM) for f in (lm_score.score, lm_score.score_by_joins))
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert x[:2] == y[:2] and all(p == q or abs(p - q) < 1e-6 * max(1, abs(q)) for p, q in zip(x[2:], y[2:]))


def test_lm_repeated_rows_spread_and_are_pruned_exactly(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BATCH_BYTES", 2_000)
    monkeypatch.setattr(lm_score, "BUCKET_BYTES", 5_000)
    rows = [(1, brute.prose(40, 1))] * 300 + [(i, brute.prose(40, i)) for i in range(2, 60)]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string"), "copies")
    dealt, _, n_buckets = lm_score._dealt(docs, "doc_id", "text")
    sizes = [r["count"] for r in dealt.where("doc_id = 1").groupBy("batch").count().collect()]
    assert max(sizes) < 60 and n_buckets > 1
    got, want = brute.rows_of(lm_score.score(docs), *LM[:3]), brute.ordered(brute.lm(rows))
    assert all(abs(g[2] - w[2]) < 1e-6 * abs(w[2]) for g, w in zip(got, want))


def test_lm_merged_requests(spark, monkeypatch):
    """More buckets than a batch is cut into: two rounds of merging."""
    docs = stored(both(spark), "both")
    want = brute.ordered(brute.lm(docs_of(spark)))
    monkeypatch.setattr(lm_score, "BATCH_BYTES", 30_000)
    monkeypatch.setattr(lm_score, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(lm_score, "FAN", 3)
    assert lm_score._dealt(docs, "doc_id", "text")[2] > 9
    for g, w in zip(brute.rows_of(lm_score.score(docs), *LM[:3]), want, strict=True):
        assert g[:2] == w[:2] and abs(g[2] - w[2]) < 1e-6 * max(1, abs(w[2]))


def test_lm_counts_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b a b"), (2, "A b c"), (3, None)], "doc_id long, text string")
    n = {(r.k, r.n) for r in lm_score.count_tables(docs, 2).collect()}
    assert n == {(1, 3), (1, 1), (2, 3), (2, 1)}
    assert lm_score.score(brute.none(spark)).count() == 0


def test_lm_codes():
    h = np.sort(np.random.default_rng(5).integers(0, 1 << 64, 500, dtype=np.uint64))
    for k in (1, 2, 500):
        assert (lm_score.unpack_hashes(lm_score.pack_hashes(h[:k]), k) == h[:k]).all()
    for n in (np.array([1, 70000, 3]), np.array([1 << 40, 2]), np.ones(9, np.int64), np.zeros(3, np.int64)):
        for usual in (0, 1):
            assert (lm_score.unpack_counts(lm_score.pack_counts(n, usual), len(n), usual) == n).all()
