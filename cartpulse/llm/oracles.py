"""DuckDB statements of the answers that SQL can express.

They say what is computed, not how: all pairs that share a shingle, all seeds by
their tokens instead of hashes, and alignments scored by running sums.
"""

from __future__ import annotations

import string

from cartpulse.llm.decontamination import MASKS, MIN_SCORE, MISMATCH, SHORT

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
           '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, ws[i] || ' ' || ws[i + 1] AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM w WHERE len(ws) >= 2)
  UNION ALL SELECT doc_id, ws[1] FROM w WHERE len(ws) = 1),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * c >= 80 * (a.n + b.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(node, r) AS (
  SELECT x, x FROM both_ways
  UNION SELECT b.y, r FROM reach JOIN both_ways b ON b.x = node),
comp AS (SELECT node, min(r) AS c FROM reach GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       coalesce(comp.c, d.doc_id) AS component_id,
       d.doc_id = coalesce(comp.c, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp ON comp.node = d.doc_id"""


def _seeds(table: str, key: str) -> str:
    parts = []
    for m, mask in enumerate(MASKS):
        toks = " || ' ' || ".join(f"t[p + {i + 1}]" for i, bit in enumerate(mask) if bit == "1")
        parts.append(f"SELECT {key}, p, {m} AS m, {toks} AS seed FROM (SELECT {key}, t, "
                     f"unnest(range(0, len(t) - {len(mask) - 1})) AS p FROM {table} "
                     f"WHERE len(t) >= {len(mask)})")
    return " UNION ALL ".join(parts)


DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS t
           FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS t
      FROM benchmark),
hits AS (
  SELECT DISTINCT doc_id, item_id, x.p - y.p AS diagonal
  FROM ({_seeds('d', 'doc_id')}) x JOIN ({_seeds('b', 'item_id')}) y USING (m, seed)
  UNION
  SELECT doc_id, item_id, p FROM (SELECT doc_id, t, unnest(range(0, len(t))) AS p FROM d) x
  JOIN b ON len(b.t) BETWEEN {SHORT} AND {min(map(len, MASKS)) - 1} AND x.t[p + 1:p + len(b.t)] = b.t
  UNION
  SELECT doc_id, item_id, 0 FROM d JOIN b ON d.t = b.t AND len(b.t) BETWEEN 1 AND {SHORT - 1}),
aligned AS (
  SELECT h.*, len(b.t) AS n_item, i,
         CASE WHEN d.t[diagonal + i + 1] = b.t[i + 1] THEN 1 ELSE {MISMATCH} END AS gain
  FROM hits h JOIN d USING (doc_id) JOIN b USING (item_id),
       unnest(range(greatest(0, -diagonal), least(len(b.t), len(d.t) - diagonal))) AS u(i)),
sums AS (
  SELECT doc_id, item_id, diagonal, n_item, i + 1 AS k,
         sum(gain) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY i) AS s
  FROM aligned
  UNION ALL
  SELECT doc_id, item_id, diagonal, any_value(n_item), min(i), 0 FROM aligned GROUP BY ALL),
scored AS (
  SELECT *, s - min(s) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY k
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS score
  FROM sums),
ends AS (
  SELECT * FROM scored WHERE score IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY score DESC, k) = 1),
runs AS (
  SELECT e.doc_id, e.item_id, e.diagonal, e.score, e.k AS last, max(z.k) AS first
  FROM ends e JOIN sums z ON z.doc_id = e.doc_id AND z.item_id = e.item_id
   AND z.diagonal = e.diagonal AND z.k < e.k AND z.s = e.s - e.score
  WHERE e.score >= least({MIN_SCORE}, ceil(e.n_item * 6 / 10))
  GROUP BY ALL)
SELECT doc_id, item_id, CAST(score AS INTEGER) AS score,
       CAST((score - ({MISMATCH}) * (last - first)) // {1 - MISMATCH} AS INTEGER) AS matched_words,
       CAST(last - first AS INTEGER) AS run_words,
       CAST(diagonal + first AS INTEGER) AS start_word, CAST(first AS INTEGER) AS item_start
FROM runs
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id
  ORDER BY score DESC, last - first DESC, diagonal + first, first DESC) = 1"""


# CRC-32 of the decimal digits, bit by bit.
CRC32 = """xor(4294967295, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                                                 lambda d: CAST(ascii(d) AS BIGINT))),
    lambda c, d: list_reduce(list_concat([xor(c, d)], [CAST(i AS BIGINT) FOR i IN range(8)]),
      lambda v, i: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END))))"""

PREFIX_TRIE = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS head, {CRC32} % 6 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
k AS (SELECT c.*, (SELECT count(*) FROM t WHERE t.conv_id = c.head AND t.pos <= c.h) AS k FROM c),
rebuilt AS (
  SELECT k.conv_id, t.pos AS depth, role, text FROM k JOIN t ON t.conv_id = k.head AND t.pos <= k.h
  UNION ALL
  SELECT k.conv_id, k.k + t.pos - k.h, role, text FROM k JOIN t ON t.conv_id = k.conv_id AND t.pos > k.h),
paths AS (
  SELECT conv_id, depth, text,
         string_agg(len(role) || ':' || role || len(text) || ':' || text, '') OVER (
           PARTITION BY conv_id ORDER BY depth) AS path
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, '', '' FROM c),
members AS (
  SELECT conv_id, depth, text, min(conv_id) OVER (PARTITION BY depth, path) AS node,
         depth = max(depth) OVER (PARTITION BY conv_id) AS ends
  FROM paths),
nodes AS (
  SELECT node, depth, count(*) AS n_convs, (count(*) - 1) * any_value(len(text)) AS saved,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ids
  FROM members GROUP BY ALL),
up AS (SELECT n.node, n.depth, m.node AS parent FROM nodes n
       LEFT JOIN members m ON m.conv_id = n.node AND m.depth = n.depth - 1),
children AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n FROM up
             WHERE parent IS NOT NULL GROUP BY ALL),
own AS (SELECT n.*, coalesce(children.n, 0) AS n_children FROM nodes n LEFT JOIN children USING (node, depth)),
sums AS (
  SELECT m.node, m.depth, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves, sum(u.saved) AS saved_tokens
  FROM own u JOIN members m ON m.conv_id = u.node AND m.depth <= u.depth GROUP BY ALL)
SELECT own.node AS conv_id, CAST(own.depth AS BIGINT) AS depth, up.parent AS parent_conv_id, own.n_convs,
       own.n_children, sums.n_leaves, CAST(sums.saved_tokens AS BIGINT) AS saved_tokens,
       sha256(own.ids) AS ends_sha256
FROM own JOIN up USING (node, depth) JOIN sums USING (node, depth)"""

HARD_NEGATIVES = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS alike,
         CAST(list_sum(list_transform(list_zip(a.v, o.v), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
  FROM r a JOIN r o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id),
pos AS (SELECT * FROM s WHERE alike
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM pos p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.alike
 AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10"""
