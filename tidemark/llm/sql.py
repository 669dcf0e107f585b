"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

import string

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024.0 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)
SELECT q.vec_id AS query_id, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.e, c.e) DESC, c.vec_id) AS INT) AS rank,
  c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.e, c.e) DESC, c.vec_id) <= 10
"""

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s FROM w, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 185 * o >= 85 * (a.n + b.n)),
linked AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, linked.y FROM reach JOIN linked ON reach.b = linked.x)
SELECT a AS doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(b) AS component_id FROM reach LEFT JOIN n ON n.doc_id = a GROUP BY 1
"""

#: Each distinct prefix is named by a hash; a node's aggregates come from its owner's path.
PREFIX_TRIE = """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, count(*) AS own FROM t GROUP BY c),
crc AS (
  WITH RECURSIVE bytes AS (
    SELECT c, CAST(c AS VARCHAR) AS s, 1 AS i, 0 AS bit, CAST(4294967295 AS UBIGINT) AS r FROM n
    UNION ALL
    SELECT c, s, CASE WHEN bit = 8 THEN i + 1 ELSE i END, CASE WHEN bit = 8 THEN 0 ELSE bit + 1 END,
      CASE WHEN bit = 0 THEN xor(r, CAST(ascii(s[i]) AS UBIGINT))
        WHEN r % 2 = 1 THEN xor(r // 2, CAST(3988292384 AS UBIGINT)) ELSE r // 2 END
    FROM (SELECT c, s, i, bit, r FROM bytes WHERE i <= length(s)) AS b)
  SELECT c, CAST(xor(r, CAST(4294967295 AS UBIGINT)) % 6 AS BIGINT) AS h FROM bytes WHERE i = length(s) + 1),
heads AS (
  SELECT crc.c, t.pos AS seq, 0 AS part, t.role, t.text FROM crc JOIN t ON t.c = crc.c - crc.c % 100 AND t.pos <= crc.h
  UNION ALL SELECT t.c, t.pos, 1, t.role, t.text FROM t JOIN crc ON crc.c = t.c AND t.pos > crc.h),
r AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, seq) AS d, length(text) AS len,
    sha256(concat(length(role), ':', role, text)) AS one FROM heads),
p AS (SELECT c, d, len, sha256(string_agg(one, ',') OVER (PARTITION BY c ORDER BY d)) AS k FROM r
  UNION ALL SELECT c, 0, 0, '' FROM n),
size AS (SELECT c, max(d) AS n FROM p GROUP BY c),
node AS (SELECT k, d, min(c) AS o, count(*) AS m, max(len) AS len FROM p GROUP BY k, d),
up AS (SELECT node.k, node.d, a.k AS pk FROM node JOIN p a ON a.c = node.o AND a.d = node.d - 1),
kids AS (SELECT pk AS k, count(*) AS kids FROM up GROUP BY pk),
below AS (
  SELECT a.k, sum(CASE WHEN kids.k IS NULL THEN 1 ELSE 0 END) AS leaves, sum((node.m - 1) * node.len) AS saved
  FROM node JOIN p a ON a.c = node.o AND a.d <= node.d LEFT JOIN kids ON kids.k = node.k GROUP BY a.k),
ends AS (SELECT p.k, string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) AS ids FROM p JOIN size ON size.c = p.c AND size.n = p.d GROUP BY p.k)
SELECT node.o AS conv_id, CAST(node.d AS BIGINT) AS depth, parent.o AS parent_conv_id, CAST(node.m AS BIGINT) AS n_convs,
  CAST(coalesce(kids.kids, 0) AS BIGINT) AS n_children, CAST(below.leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM node JOIN below ON below.k = node.k LEFT JOIN up ON up.k = node.k LEFT JOIN node parent ON parent.k = up.pk
LEFT JOIN kids ON kids.k = node.k LEFT JOIN ends ON ends.k = node.k
"""


def vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Plain nearest entries, round by round; distances are whole numbers below 2^53."""
    away = "list_dot_product(q, q) - 2 * list_dot_product(q, c) + list_dot_product(c, c)"
    steps = []
    for r in range(1, rounds + 2):
        steps.append(f"""
a{r} AS (SELECT vec_id, p, any_value(q) AS q, min({{'d': CAST({away} AS BIGINT), 'k': k}}) AS m FROM part JOIN b{r - 1} USING (p) GROUP BY vec_id, p)""")
        if r <= rounds:
            steps.append(f"""
s{r} AS (SELECT p, k, i, sum(x) AS s, count(*) AS n FROM (SELECT p, m.k AS k, unnest(range(1, len(q) + 1)) AS i, unnest(q) AS x FROM a{r}) GROUP BY p, k, i),
m{r} AS (SELECT p, k, list(CAST((s - ((CAST(s AS BIGINT) % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{r} GROUP BY p, k),
b{r} AS (SELECT p, k, coalesce(m{r}.c, b{r - 1}.c) AS c FROM b{r - 1} LEFT JOIN m{r} USING (p, k))""")
    return f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024.0 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
part AS (SELECT vec_id, p, e[p * (len(e) // {parts}) + 1:(p + 1) * (len(e) // {parts})] AS q FROM v, LATERAL (SELECT unnest(range({parts})) AS p)),
b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, q AS c FROM part QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {entries}),
{",".join(steps)},
book AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, k, i)) AS codebooks_sha256 FROM (SELECT p, k, unnest(range(1, len(c) + 1)) AS i, unnest(c) AS x FROM b{rounds})),
coded AS (SELECT vec_id, string_agg(format('{{:02x}}', m.k), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds + 1} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256, label FROM coded JOIN v USING (vec_id), book
"""

REPEATS = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS s FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 33)) AS i)),
again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY s) > 1),
word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
marked AS (
  SELECT word.doc_id, word.i, word.word, max(CASE WHEN again.i IS NULL THEN 0 ELSE 1 END)
    OVER (PARTITION BY word.doc_id ORDER BY word.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM word LEFT JOIN again ON again.doc_id = word.doc_id AND again.i = word.i),
kept AS (SELECT doc_id, sum(gone) AS gone, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS text FROM marked GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(kept.gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""
