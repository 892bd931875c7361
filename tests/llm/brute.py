"""Plain reference versions of the operators, and the edge-case table."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def prose(n, seed, words="the of and to in a is that it for on was with as by be this are from or an house tree river "
          "stone light water garden window morning evening letter journey silver forest".split()):
    r = random.Random(seed)
    out = []
    for i in range(n):
        w = r.choice(words) + (r.choice("abcdefgh") * r.randint(0, 2) if r.random() < 0.3 else "")
        out.append(w + ("." if i % 11 == 10 else ""))
    return " ".join(out)


SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, kept string, fp string, "
          "t string, batch int, start int, _row int, _key string, hits string, cut string")
EXTRA = (0.5, "x", "y", "z", 1, 2, 3, "k", "h", "c")


def edge_rows():
    """Nulls in each column, empty and blank texts, a very long text and word,
    repeated rows, ties, marks only, and clashing column names."""
    long = prose(30000, 5)
    texts = [
        (1, prose(60, 1)), (2, None), (3, ""), (4, " \n\t "), (5, long), (None, prose(40, 2)), (None, None),
        (6, prose(50, 3)), (6, prose(50, 3)), (7, prose(50, 3)), (8, "!!! ### 123 456"), (9, "x" * 20000),
        (10, "One two three."), (11, "Ünïcödé Straße 日本語 テスト ΣΑΣ İx"), (12, prose(50, 3) + " extra"),
        (None, prose(40, 2)), (13, "line one here\n" * 30), (14, " a\x1cb\x85c d e"), (15, "a\n\nb\r\nc"),
    ]
    rows = []
    for i, (d, t) in enumerate(texts):
        rows.append((d, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s1", None if i % 5 == 0 else 7, *EXTRA))
    rows.append((16, "all null beside", *[None] * 13))
    return rows


def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


# ------------------------------------------------------------------ operators


def lm(rows, order=3, backoff=0.4, min_count=1):
    ws = [ALNUM.findall(low(t or "")) for _, t in rows]
    f = [Counter(tuple(x[i:i + k]) for x in ws for i in range(len(x) - k + 1)) for k in range(1, order + 1)]
    n = sum(f[0].values())

    def s(h, w):
        if not h:
            return math.log(f[0][w,] / n)
        if f[len(h)][*h, w] >= min_count:
            return math.log(f[len(h)][*h, w] / f[len(h) - 1][h])
        return math.log(backoff) + s(h[1:], w)

    return [(d, len(x), sum(s(tuple(x[max(0, i - order + 1):i]), w) for i, w in enumerate(x)))
            for (d, _), x in zip(rows, ws)]


def base_counts(t):
    t = t or ""
    w = WORD.findall(t)
    win = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = np.zeros(len(w), bool)
    for i in range(len(w) - 7):
        if win[tuple(w[i:i + 8])] > 1:
            cover[i:i + 8] = True
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, int(cover.sum())


def simhash(t):
    w = WORD.findall(low(t or ""))
    if not w:
        return 0
    c, k = [0] * 64, min(4, len(w))
    for i in range(len(w) - k + 1):
        h = xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42)
        for b in range(64):
            c[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * c[b] > len(w) - k + 1)


def groups(fps, bits=4):
    """Component of each fingerprint, as the set of its indices."""
    f = np.array(fps, np.uint64)
    label = np.arange(len(f))
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= bits
    while True:
        new = np.where(near, label[None], len(f)).min(1)
        if (new == label).all():
            return label.tolist()
        label = new


def contamination(rows, items, min_share=20):
    win = {}
    for i, t in items:
        w = ALNUM.findall(low(t or ""))
        k = min(13, len(w))
        if i is not None and k:
            for s in range(len(w) - k + 1):
                win.setdefault(tuple(w[s:s + k]), set()).add(i)
    out = []
    for d, t in rows:
        w = ALNUM.findall(low(t or ""))
        hit, ids = np.zeros(len(w), bool), set()
        for k in {len(x) for x in win}:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in win:
                    hit[s:s + k] = True
                    ids |= win[tuple(w[s:s + k])]
        n, names = int(hit.sum()), sorted(map(str, ids))
        out.append((d, len(w), n, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                    n > 0 and min_share * n >= len(w)))
    return out


def crc_ids(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def rows_of(df, *columns):
    """Rows as sorted tuples, nulls first."""
    return ordered(tuple(r) for r in df.select(*columns).collect())


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))
