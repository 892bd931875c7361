"""Conversation trie, Merkle manifest and nearest neighbours against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

import brute
from cellhouse.llm import ann, conv_trie, merkle
from cellhouse.llm.common import table

SF = "/root/testdata/sf0.001"
CONV = "conv_id long, turn long, role string, text string, conv string, at int, block int, n int, least int, h1 string"
VEC = "vec_id long, embedding array<float>, label int, row string, share double, bar double, block int, d string"


# ------------------------------------------------------------ conversation trie


def trie(rows):
    by = {}
    for c, t, r, x in rows:
        if c is not None:
            by.setdefault(c, []).append((t is not None, t or 0, (r or "").encode(), (x or "").encode()))
    own = {c: [v[2:] for v in sorted(vs)] for c, vs in by.items()}
    path = {}
    for c, turns in own.items():
        h, lead = zlib.crc32(str(c).encode()) % 9, c - (c % 5 if c >= 0 else -(-c % 5))
        path[c] = tuple(own.get(lead, [])[:h] + turns[h:])
    members, kids = {}, {}
    for c, p in path.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    saved, leaves = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in below)
        leaves[p] = sum(leaves[k] for k in below) if below else 1
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
             hashlib.sha256(",".join(str(c) for c in sorted(m) if len(path[c]) == len(p)).encode()).hexdigest())
            for p, m in members.items()]


def edge_conversations():
    r, extra = random.Random(3), ("x", 1, 2, 3, 4, "h")
    rows = [(None, 1, "user", "lost"), (-7, 0, "user", "a"), (-5, 0, "user", "b"), (-5, None, None, None), (4, 0, "user", ""),
            (4, 0, "user", ""), (9, None, "x", "Ünï"), (9, None, "x", "Ünï"), (9, 2, None, "z" * 50000), (11, 3, "ab", "c"),
            (11, 4, "a", "bc"), (12, 3, "ab", "c"), (12, 4, "a", "bc")]
    for c in range(20, 80):  # shared openings of all lengths, and equal conversations
        kind = r.randrange(4)
        rows += [(c, t, "ua"[t % 2], f"turn {t if kind else t // 9}" + ("!" if t == 6 + kind else ""))
                 for t in range(r.choice([1, 3, 4, 5, 8, 9, 13]))]
    rows += [(100, t, "u", f"{t % 7}") for t in range(150)] + [(101, t, "u", f"{t % 7}") for t in range(150)]
    return [(*x, *extra) for x in rows]


def nodes_of(df):
    assert [f.simpleString() for f in df.schema] == [
        "conv_id:bigint", "depth:bigint", "parent_conv_id:bigint", "n_convs:bigint", "n_children:bigint",
        "n_leaves:bigint", "saved_tokens:bigint", "ends_sha256:string"]
    return brute.ordered(tuple(r) for r in df.collect())


def test_trie_against_brute_force(spark):
    rows = edge_conversations()
    df = spark.createDataFrame(rows, CONV).repartition(3)
    assert nodes_of(conv_trie.prefix_trie(df)) == brute.ordered(trie([r[:4] for r in rows]))
    given = table(spark, SF, "conversations")
    want = trie([tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()])
    assert nodes_of(conv_trie.prefix_trie(given)) == brute.ordered(want)
    assert nodes_of(conv_trie.prefix_trie(df.where("false"))) == []
    assert nodes_of(conv_trie.prefix_trie(df.where("conv_id is null"))) == []


def test_trie_long_conversations_and_chunked_ends(spark, monkeypatch):
    monkeypatch.setattr(conv_trie, "RUN", 2)  # carried prefixes
    monkeypatch.setattr(conv_trie, "CHUNK_BYTES", 10)  # many chunks of one node's ids
    rows = edge_conversations() + [(c, 0, "u", "same", "x", 1, 2, 3, 4, "h") for c in range(1000, 1300)]
    df = spark.createDataFrame(rows, CONV)
    assert nodes_of(conv_trie.prefix_trie(df)) == brute.ordered(trie([r[:4] for r in rows]))


def test_only_diverging_blocks_are_refined(spark):
    rows = [(c, t, "u", f"{t}" if t < 10 else f"{c}") for c in (10, 15) for t in range(12)]
    turns = conv_trie.numbered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    blocks = conv_trie.blocks_of(turns).groupBy("block").agg({"e1": "count"}).collect()
    assert sorted(map(tuple, blocks)) == [(0, 2), (1, 2), (2, 2)]
    groups = conv_trie.blocks_of(turns).select("block", "s1", "e1").distinct().groupBy("block").count().collect()
    assert sorted(map(tuple, groups)) == [(0, 1), (1, 1), (2, 2)]


# -------------------------------------------------------------- Merkle manifest


def put(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return merkle.digest("".join(map(put, (r[0], r[2], r[1], r[3], text))))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([merkle.digest("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def around(levels, i):
    out = []
    for x in levels[:-1]:
        out.append(("".join(x[i - i % 8:i]), "".join(x[i + 1:i - i % 8 + 8])))
        i //= 8
    return out


def proofs(rows):
    """From rows (doc_id, lang, source, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for rs in by.values():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
    trees = {g: tree([leaf(r, r[4]) for r in by[g]]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(by[g]):
            path = around(trees[g], i) + around(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            at = leaf(r, brute.low(r[4])) if hit and r[4] is not None else trees[g][0][i]
            for a, b in path:
                at = merkle.digest(a + at + b)
            out.append((r[0], trees[g][0][i], trees[g][-1][0], top[-1][0],
                        merkle.digest("".join(a + b for a, b in path)), at, at == top[-1][0]))
    return out


MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
FIELDS = ["doc_id", "lang", "source", "n_chars", "text"]


@pytest.mark.parametrize("depth", [4, 1])
def test_manifest_against_brute_force(spark, depth):  # 1: blocks of eight, many rounds
    edge = brute.edge(spark)
    many = spark.range(40).selectExpr("id + 500 as doc_id", "concat('L', id) as lang", "'s' as source",
                                      "id as n_chars", "'Text' as text")
    both = table(spark, SF, "documents").select(*FIELDS).union(many)
    for df in (edge, both) if depth == 4 else (both, edge.limit(1), many):
        want = proofs([tuple(r) for r in df.select(*FIELDS).collect()])
        got = merkle.manifest(df, depth=depth)
        assert got.columns[:7] == MANIFEST and brute.rows_of(got, *MANIFEST) == brute.ordered(want)
    assert merkle.manifest(brute.none(spark)).collect() == []


def test_versions_copy_only_ancestors(spark):
    docs = table(spark, SF, "documents")
    for r in merkle.manifest(docs).collect():
        hit = zlib.crc32(str(r.doc_id).encode()) % 3 == 0
        assert (r.version is not None) == hit and merkle.digest("".join(r.proof)) == r.proof_sha256
        if hit:
            assert len(r.version) == len(r.proof) + 1 and r.version[-1] == r.folded_root
            assert r.verified == (r.version[0] == r.leaf)


# ----------------------------------------------------------- nearest neighbours


def nearest(rows, k=20, every=20):
    rows = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = []
    for a, (q, u) in enumerate(rows):
        if q % every == 0:
            found = []
            for b, (i, v) in enumerate(rows):
                if a != b and len(u) == len(v):
                    s = 0.0
                    for x, y in zip(u, v):
                        s += x * y
                    found.append((-s, i))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(found)[:k], 1)]
    return out


def edge_vectors():
    r = np.random.default_rng(5)
    f = lambda *v: [float(np.float32(x)) for x in v]
    rows = [(i, f(*r.standard_normal(5))) for i in range(300)] + [(i, f(1, 2, 3, 4, 5)) for i in range(300, 420)]
    rows += [(20, f(1, 2, 3, 4, 5)), (20, f(1, 2, 3, 4, 5)), (500, f(1e18, -1e18, 1, 0, 0)), (520, f(1e-18, 0, 0, 0, 0)),
             (501, None), (502, []), (503, [0.0] * 5), (504, [1.0, None, 1.0, 1.0, 1.0]), (505, [float("nan")] * 5),
             (506, [float("inf"), 1.0, 1.0, 1.0, 1.0]), (None, f(1, 1, 1, 1, 1)), (540, f(2)), (541, f(3)), (560, f(1, 2)),
             (-20, f(*r.standard_normal(70))), (7, f(*r.standard_normal(70))), (8, f(*r.standard_normal(70)))]
    return [(i, v, 1, "r", 0.5, 0.5, 2, "d") for i, v in rows]


def test_neighbours_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 64)  # many rounds and blocks
    monkeypatch.setattr(ann, "QUERY_BLOCK", 8)
    rows = edge_vectors()
    df = spark.createDataFrame(rows, VEC).repartition(3)
    got = brute.ordered(tuple(r) for r in ann.search(df).collect())
    assert got == brute.ordered(nearest([r[:2] for r in rows]))
    assert ann.search(df.where("false")).collect() == [] and ann.search(df.where("vec_id = 500")).collect() == []


def test_recall_on_the_given_vectors(spark):
    given = table(spark, SF, "embeddings")
    want = nearest([(r.vec_id, r.embedding) for r in given.collect()])
    got = [tuple(r) for r in ann.search(given).collect()]
    assert len(set(got) & set(want)) >= 0.99 * len(want) and len(got) == len(want)


def test_estimates_are_within_their_bounds():
    r = np.random.default_rng(2)
    for d in (3, 64, 100):
        x, q, c = r.standard_normal((4000, d)) + 0.3, r.standard_normal((20, d)), np.full(d, 0.3)
        code = ann.Codes(x, c)
        value, error = ann.estimates(q, c, code.words, code.length, code.a)
        assert code.words.shape == (4000, -(-d // 64))
        assert (np.abs(value - q @ x.T) <= error).mean() > 0.99
