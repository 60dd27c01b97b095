"""DuckDB SQL of the later operators' queries."""

from __future__ import annotations


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR) END"


# crc32 is folded bit by bit over the id's digits; trees grow level by level and claims climb them likewise.
MERKLE = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, lang, {_field('doc_id')} || {_field('source')} || {_field('lang')} AS head, {_field('n_chars')} AS n, {_field('CAST(n_chars AS BIGINT) + 1')} AS n1, {_field('text')} AS tail,
    xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295) AS crc FROM documents),
leaves AS (SELECT doc_id, lang, sha256(head || n || tail) AS leaf, sha256(head || CASE WHEN crc % 7 = 0 THEN n1 ELSE n END || tail) AS claim FROM base),
placed AS (SELECT *, DENSE_RANK() OVER (ORDER BY lang NULLS FIRST) AS g, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
t AS (SELECT g, 0 AS level, i, leaf AS digest FROM placed UNION ALL
  SELECT g, level + 1, i // 2, sha256(string_agg(digest, '' ORDER BY i)) FROM (SELECT *, COUNT(*) OVER (PARTITION BY g) AS c FROM t) WHERE c > 1 GROUP BY g, level, i // 2),
subroots AS (SELECT g, digest AS subroot, level AS h FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY g ORDER BY level DESC) AS r FROM t) WHERE r = 1),
top AS (SELECT 0 AS level, g - 1 AS i, subroot AS digest FROM subroots UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(digest, '' ORDER BY i)) FROM (SELECT *, COUNT(*) OVER () AS c FROM top) WHERE c > 1 GROUP BY level, i // 2),
root AS (SELECT digest AS root, level AS h FROM top ORDER BY level DESC LIMIT 1),
low AS (SELECT p.g, p.i AS leaf_i, 0 AS level, p.i, p.claim AS fold, '' AS proof FROM placed p UNION ALL
  SELECT l.g, l.leaf_i, l.level + 1, l.i // 2, sha256(CASE WHEN s.digest IS NULL THEN l.fold WHEN l.i % 2 = 1 THEN s.digest || l.fold ELSE l.fold || s.digest END), l.proof || COALESCE(s.digest, '')
  FROM low l JOIN subroots r ON r.g = l.g AND l.level < r.h LEFT JOIN t s ON s.g = l.g AND s.level = l.level AND s.i = xor(l.i, 1)),
high AS (SELECT l.g, l.leaf_i, 0 AS level, l.g - 1 AS i, l.fold, l.proof FROM low l JOIN subroots r ON r.g = l.g AND r.h = l.level UNION ALL
  SELECT l.g, l.leaf_i, l.level + 1, l.i // 2, sha256(CASE WHEN s.digest IS NULL THEN l.fold WHEN l.i % 2 = 1 THEN s.digest || l.fold ELSE l.fold || s.digest END), l.proof || COALESCE(s.digest, '')
  FROM high l JOIN root r ON l.level < r.h LEFT JOIN top s ON s.level = l.level AND s.i = xor(l.i, 1))
SELECT p.doc_id, p.leaf, r.subroot, o.root, sha256(f.proof) AS proof_sha256, f.fold AS folded_root, f.fold = o.root AS verified
FROM placed p JOIN subroots r USING (g) JOIN high f ON f.g = p.g AND f.leaf_i = p.i JOIN root o ON o.h = f.level
""".strip()

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms(text: str) -> str:
    return f"UNNEST(regexp_extract_all(translate({text}, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"


# Every document that shares a term with an item is scored.
RANKED = f"""
WITH d AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, text FROM documents),
words AS (SELECT r, {_terms('text')} AS term FROM d),
tf AS (SELECT r, term, COUNT(*) AS tf FROM words GROUP BY r, term),
sizes AS (SELECT r, SUM(tf) AS n FROM tf GROUP BY r),
total AS (SELECT COUNT(*) AS docs, CAST(SUM(n) AS BIGINT) AS terms FROM sizes),
df AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term),
asked AS (SELECT item_id, term, COUNT(*) AS reps FROM
  (SELECT item_id, {_terms('text')} AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, term),
weights AS (SELECT a.item_id, a.term, a.reps * CAST(FLOOR(1000 * LN((2.0::DOUBLE * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM asked a JOIN df USING (term), total),
norms AS (SELECT r, 75 + CAST(25 * n * docs AS BIGINT) // terms AS m FROM sizes, total),
scores AS (SELECT w.item_id, t.r, CAST(SUM(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 12 * m.m))) AS BIGINT) AS score
  FROM weights w JOIN tf t USING (term) JOIN norms m ON m.r = t.r GROUP BY w.item_id, t.r),
ranked AS (SELECT s.item_id, CAST(ROW_NUMBER() OVER (PARTITION BY s.item_id ORDER BY s.score DESC, d.doc_id NULLS LAST) AS INTEGER) AS rank, d.doc_id, s.score
  FROM scores s JOIN d USING (r) WHERE s.score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
""".strip()
