"""Reference SQL (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

# base32 of a SHA-1: eight groups of five hex digits give four digits each
_OP4 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (
  SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha1(payload) AS digest,
         min(page_id) OVER (PARTITION BY payload) AS smallest
  FROM p),
b AS (
  SELECT *, list_transform(range(0, 8), lambda i: CAST('0x' || substr(digest, CAST(5 * i + 1 AS INTEGER), 5) AS BIGINT)) AS groups FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((groups[CAST(i // 4 + 1 AS INTEGER)] >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = smallest OR smallest IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = smallest OR smallest IS NULL THEN NULL ELSE smallest END AS refers_to
FROM b
"""

_OP12 = """
WITH RECURSIVE r AS (
  SELECT row_number() OVER () AS i, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (
  SELECT i, vec_id, len(v) AS dim, v FROM r
  WHERE len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v) AND len(list_filter(v, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.i AS i, b.i AS j FROM u a JOIN u b ON a.dim = b.dim AND a.i <> b.i
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT i, i AS j FROM r
  UNION
  SELECT reach.i, link.j FROM reach JOIN link ON reach.j = link.i),
component AS (
  SELECT reach.i, min(r.vec_id) AS component_id FROM reach JOIN r ON reach.j = r.i GROUP BY reach.i),
degree AS (SELECT i, count(*) AS n FROM link GROUP BY i)
SELECT r.vec_id, CAST(coalesce(degree.n, 0) AS BIGINT) AS n_links, component_id,
       r.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM r JOIN component USING (i) LEFT JOIN degree USING (i)
"""

# pieces and words by pattern; phrases of 1 to 3 words, counted per language
_OP13 = """
WITH p AS MATERIALIZED (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS MATERIALIZED (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
i AS MATERIALIZED (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
t AS MATERIALIZED (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM i),
f1 AS MATERIALIZED (SELECT lang, x, count(*) AS n FROM t GROUP BY lang, x),
f2 AS MATERIALIZED (SELECT lang, x, y, count(*) AS n FROM t WHERE y IS NOT NULL GROUP BY lang, x, y HAVING count(*) >= 10),
f3 AS MATERIALIZED (SELECT lang, x, y, z, count(*) AS n FROM t WHERE z IS NOT NULL GROUP BY lang, x, y, z HAVING count(*) >= 10),
cut AS (
  SELECT c.lang, c.x || ' ' || c.y AS phrase, c.n AS a, 1 AS k, l.n AS l, r.n AS r
  FROM f2 c JOIN f1 l ON l.lang = c.lang AND l.x = c.x JOIN f1 r ON r.lang = c.lang AND r.x = c.y
  UNION ALL
  SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.n, 1, l.n, r.n
  FROM f3 c JOIN f1 l ON l.lang = c.lang AND l.x = c.x JOIN f2 r ON r.lang = c.lang AND r.x = c.y AND r.y = c.z
  UNION ALL
  SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.n, 2, l.n, r.n
  FROM f3 c JOIN f2 l ON l.lang = c.lang AND l.x = c.x AND l.y = c.y JOIN f1 r ON r.lang = c.lang AND r.x = c.z),
scored AS (
  SELECT *, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cut),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(n) AS n
  FROM (SELECT lang, x || ' ' || y AS phrase, n FROM f3 UNION ALL SELECT lang, y || ' ' || z, n FROM f3)
  GROUP BY lang, phrase),
kept AS (
  SELECT c.lang, c.phrase, a, l, r, score
  FROM lowest c LEFT JOIN longer ON longer.lang = c.lang AND longer.phrase = c.phrase
  WHERE 100 * coalesce(longer.n, 0) < 50 * a),
total AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, total.n, score
FROM kept JOIN total USING (lang)
QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_warc": _OP4, "op12_embedding_dedup": _OP12, "op13_collocations": _OP13}
