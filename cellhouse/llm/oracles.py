"""DuckDB SQL for the queries that SQL can express."""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"
_BLANKS = r"[^\x20\x09-\x0D]+"

OP1 = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
t AS (SELECT doc_id, w[i] AS c, CASE WHEN i > 1 THEN w[i - 1] END AS b, CASE WHEN i > 2 THEN w[i - 2] END AS a FROM p),
f1 AS (SELECT c, count(*) AS n FROM t GROUP BY c),
f2 AS (SELECT b, c, count(*) AS n FROM t WHERE b IS NOT NULL GROUP BY b, c),
f3 AS (SELECT a, b, c, count(*) AS n FROM t WHERE a IS NOT NULL GROUP BY a, b, c),
s AS (SELECT t.doc_id, CASE WHEN f3.n >= 1 THEN ln(f3.n / h2.n)
        WHEN f2.n >= 1 THEN ln(f2.n / h1.n) + CASE WHEN t.a IS NULL THEN 0 ELSE ln(0.4) END
        ELSE ln(u.n / (SELECT count(*) FROM t)) + CASE WHEN t.b IS NULL THEN 0 WHEN t.a IS NULL THEN ln(0.4)
             ELSE 2 * ln(0.4) END END AS x
      FROM t JOIN f1 u ON u.c = t.c LEFT JOIN f1 h1 ON h1.c = t.b LEFT JOIN f2 ON f2.b = t.b AND f2.c = t.c
           LEFT JOIN f2 h2 ON h2.b = t.a AND h2.c = t.b LEFT JOIN f3 ON f3.a = t.a AND f3.b = t.b AND f3.c = t.c),
g AS (SELECT doc_id, sum(x) AS x, avg(x) AS m FROM s GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(x, 0), 4) AS log_score,
       round(m, 6) AS mean_log_score
FROM d LEFT JOIN g USING (doc_id)
"""

OP4 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text,
                  coalesce(regexp_extract_all(text, '{_BLANKS}'), []) AS w FROM documents),
l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
n AS (SELECT doc_id, source, line, i, {_LOWER.replace('text', 'line')} AS low FROM l
      WHERE regexp_matches(line, '{_BLANKS}')),
dup AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS k
        FROM n) WHERE k > 1 GROUP BY doc_id),
q AS (SELECT doc_id, source, array_to_string(regexp_extract_all(low, '{_BLANKS}'), ' ') AS h,
             len(regexp_extract_all(low, '{_BLANKS}')) AS c FROM n),
o AS (SELECT doc_id, source, h, sum(c) AS c FROM q GROUP BY ALL),
freq AS (SELECT source, h FROM o GROUP BY ALL HAVING count(DISTINCT doc_id) > 50),
gone AS (SELECT o.doc_id, sum(o.c) AS c FROM o JOIN freq ON o.h = freq.h AND o.source IS NOT DISTINCT FROM freq.source
         GROUP BY o.doc_id),
v AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM d),
g AS (SELECT doc_id, i, w[i:i + 7] AS x FROM v),
r AS (SELECT doc_id, x FROM g GROUP BY ALL HAVING count(*) > 1),
c AS (SELECT DISTINCT g.doc_id, unnest(range(g.i, g.i + 8)) AS p FROM g JOIN r ON g.doc_id = r.doc_id AND g.x = r.x),
rep AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id),
b AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(gone.c, 0) AS BIGINT) AS removed_words
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
       AND 100 * (n_words - removed_words) >= 50 * n_words AND n_words - removed_words >= 20 AS kept
FROM b
"""

OP10 = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
k AS (SELECT item_id, w, least(13, len(w)) AS k FROM i WHERE len(w) > 0),
x AS (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS s FROM k),
win AS (SELECT DISTINCT item_id, k, w[s:s + k - 1] AS g FROM x),
ks AS (SELECT DISTINCT k FROM win),
dp AS (SELECT doc_id, k, w, unnest(range(1, greatest(1, len(w) - k + 2))) AS s FROM d, ks),
dw AS (SELECT doc_id, k, s, w[s:s + k - 1] AS g FROM dp),
hit AS (SELECT doc_id, dw.k, s, item_id FROM dw JOIN win ON dw.k = win.k AND dw.g = win.g),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + k)) AS p FROM hit),
n AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256,
       coalesce(n.n, 0) > 0 AND 20 * coalesce(n.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""


def crc32(text: str) -> str:
    """SQL of the unsigned crc32 of ASCII text: a byte, then eight shifts, and so on."""
    bits = (f"flatten(list_transform(range(1, length({text}) + 1), lambda i: list_concat("
            f"[CAST(ascii(substr({text}, i, 1)) AS BIGINT)], list_resize([CAST(-1 AS BIGINT)], 8, CAST(-1 AS BIGINT)))))")
    return (f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {bits}), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) "
            "ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END) END), "
            "CAST(4294967295 AS BIGINT))")


OP11 = f"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
             coalesce(text, '')) AS i, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS v
           FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(v ORDER BY i) AS l FROM t GROUP BY c),
h AS (SELECT c, l, c - c % 5 AS lead, {crc32('CAST(c AS VARCHAR)')} % 9 AS h FROM own),
s AS (SELECT h.c, list_concat(coalesce(b.l, [])[1:h.h], h.l[h.h + 1:]) AS s FROM h LEFT JOIN own b ON b.c = h.lead),
p AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM s),
node AS (SELECT d, s[1:d] AS k, min(c) AS least, count(*) AS n, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)
           FILTER (len(s) = d) AS ends, count(*) FILTER (len(s) = d) AS e FROM p GROUP BY 1, 2),
up AS (SELECT unnest(range(0, d + 1)) AS j, k, (n - 1) * coalesce(strlen(k[d].t), 0) AS saved,
              CAST(e = n AS BIGINT) AS leaf FROM node),
sub AS (SELECT j AS d, k[1:j] AS k, sum(saved) AS saved, sum(leaf) AS leaves FROM up GROUP BY 1, 2),
kids AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1, 2)
SELECT node.least AS conv_id, CAST(node.d AS BIGINT) AS depth, par.least AS parent_conv_id, node.n AS n_convs,
       coalesce(kids.n, 0) AS n_children, CAST(sub.leaves AS BIGINT) AS n_leaves,
       CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(coalesce(node.ends, '')) AS ends_sha256
FROM node JOIN sub ON sub.d = node.d AND sub.k = node.k LEFT JOIN kids ON kids.d = node.d AND kids.k = node.k
     LEFT JOIN node par ON par.d = node.d - 1 AND par.k = node.k[1:node.d - 1]
"""


def merkle(lower: int = 6, upper: int = 2) -> str:
    """The manifest for up to 8 ** ``lower`` rows a language and 8 ** ``upper`` languages."""
    def put(c):
        return f"coalesce(concat(strlen(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)), '-')"

    def leaf(text):
        return f"sha256(concat({', '.join(map(put, ('doc_id', 'source', 'lang', 'n_chars', text)))}))"

    def level(new, old):  # a level of a tree: runs of eight, as long as there are several nodes
        return (f"{new} AS (SELECT g, i // 8 AS i, CASE WHEN m > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END AS h, "
                f"CASE WHEN m > 1 THEN (m + 7) // 8 ELSE 1 END AS m FROM {old} GROUP BY g, i // 8, m)")

    def fold(new, old, nodes, g):  # the path goes up a level
        return (f"{new}r AS (SELECT g, i // 8 AS i, any_value(m) AS m, list(h ORDER BY i) AS l FROM {nodes} GROUP BY 1, 2), "
                f"{new}s AS (SELECT o.* EXCLUDE (i), o.i // 8 AS i, CASE WHEN m > 1 THEN array_to_string(l[1:o.i % 8], '') ELSE '' END "
                f"AS a, CASE WHEN m > 1 THEN array_to_string(l[o.i % 8 + 2:], '') ELSE '' END AS b, m FROM {old} o "
                f"JOIN {new}r r ON r.g = {g} AND r.i = o.i // 8), "
                f"{new} AS (SELECT * EXCLUDE (a, b, m, f, p), CASE WHEN m > 1 THEN sha256(a || f || b) ELSE f END AS f, "
                f"p || a || b AS p FROM {new}s)")

    steps = [f"""d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf('text')} AS leaf,
        CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {leaf(_LOWER)} ELSE {leaf('text')} END AS f FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        count(*) OVER (PARTITION BY g) AS m FROM d)""",
             "n0 AS (SELECT g, i, leaf AS h, m FROM r)"]
    steps += [level(f"n{k + 1}", f"n{k}") for k in range(lower)]
    steps.append(f"""u0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS i, h, count(*) OVER () AS m,
        g AS lang FROM n{lower})""")
    steps += [level(f"u{k + 1}", f"u{k}") for k in range(upper)]
    steps.append("f0 AS (SELECT doc_id, g, leaf, f, i, '' AS p FROM r)")
    steps += [fold(f"f{k + 1}", f"f{k}", f"n{k}", "o.g") for k in range(lower)]
    steps.append(f"""e0 AS (SELECT x.doc_id, x.leaf, x.f, x.p, u0.i, u0.h AS subroot FROM f{lower} x JOIN u0 ON u0.lang = x.g)""")
    steps += [fold(f"e{k + 1}", f"e{k}", f"u{k}", "0") for k in range(upper)]
    return f"""WITH {', '.join(steps)}
SELECT doc_id, leaf, subroot, u.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = u.h AS verified
FROM e{upper}, u{upper} u"""


OP12 = merkle()

OP13 = """
WITH v AS (SELECT vec_id, row_number() OVER () AS r, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL
             AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, q.r, x.vec_id, x.r AS xr, list_dot_product(q.e, x.e) AS score FROM v q JOIN v x
        ON q.r <> x.r AND len(q.e) = len(x.e) WHERE q.vec_id % 20 = 0),
n AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, xr) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM n WHERE rank <= 20
"""
