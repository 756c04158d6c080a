"""SQL of the operators that it can express, for DuckDB over the same tables."""

from __future__ import annotations

import string

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

TOP_K = """
WITH vectors AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 10"""

EXACT_COPIES = f"""
WITH keyed AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM keyed WINDOW same AS (PARTITION BY text_sha256)"""


def lloyd(k: int = 8, rounds: int = 10, dimension: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """Every distance in every round, one pair of tables a round."""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = {dimension} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""centres0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY hash) - 1 AS j, v FROM (
    SELECT v, sha256('{seed}:' || vec_id) AS hash FROM kept WHERE vec_id IS NOT NULL ORDER BY hash LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""assigned{i} AS MATERIALIZED (
  SELECT r, vec_id, v, j, d FROM (
    SELECT a.r, a.vec_id, a.v, c.j,
           CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM kept a CROSS JOIN centres{i} c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1)""")
        if i < rounds:
            parts.append(f"""centres{i + 1} AS MATERIALIZED (
  SELECT c.j, coalesce(m.v, c.v) AS v FROM centres{i} c LEFT JOIN (
    SELECT j, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY pos) AS v FROM (
      SELECT j, pos, sum(x) AS s, count(*) AS n FROM (
        SELECT j, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM assigned{i}) GROUP BY j, pos)
    GROUP BY j) m ON m.j = c.j)""")
    return f"""WITH {", ".join(parts)}
SELECT a.vec_id, CAST(a.j AS INTEGER) AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM assigned{rounds} a JOIN centres{rounds} c ON c.j = a.j"""


def benchmark_hits(n: int = 10) -> str:
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {n}) AS size,
         unnest([array_to_string(w[i:i + least(len(w), {n}) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), {n}) + 2)]) AS line
  FROM items WHERE len(w) > 0),
places AS (
  SELECT r, s.size, unnest(range(1, len(w) - s.size + 2)) AS pos, w FROM docs, (SELECT DISTINCT size FROM windows) s
  WHERE len(w) >= s.size),
hits AS (
  SELECT p.r, p.pos, p.size, v.item_id FROM (SELECT r, pos, size, array_to_string(w[pos:pos + size - 1], ' ') AS line FROM places) p
  JOIN windows v ON v.size = p.size AND v.line = p.line),
hit_words AS (SELECT r, count(DISTINCT word) AS n FROM (SELECT r, unnest(range(pos, pos + size)) AS word FROM hits) GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hit_words h ON h.r = d.r LEFT JOIN hit_items i ON i.r = d.r"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END"
    byte = f"list_reduce(range(8), lambda x, i: {bit}, xor(crc, b))"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda crc, b: {byte}, 4294967295::BIGINT), 4294967295::BIGINT)"


def prefix_nodes(every: int = 5, swaps: int = 9) -> str:
    """A path is the digests of its turns end to end, 64 characters each."""
    return f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % {every} AS donor, {_crc32("CAST(c AS VARCHAR)")} % {swaps} AS h FROM (SELECT DISTINCT c FROM turns)),
given AS (SELECT v.c, count(t.p) AS taken FROM convs v LEFT JOIN turns t ON t.c = v.donor AND t.p < v.h GROUP BY v.c),
rebuilt AS (
  SELECT v.c, t.p, t.role, t.text FROM convs v JOIN turns t ON t.c = v.donor AND t.p < v.h
  UNION ALL
  SELECT v.c, t.p - v.h + g.taken, t.role, t.text
  FROM convs v JOIN given g ON g.c = v.c JOIN turns t ON t.c = v.c AND t.p >= v.h),
paths AS (
  SELECT c, p + 1 AS d, octet_length(encode(text)) AS size,
         string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY p) AS path
  FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs),
members AS (SELECT *, d = max(d) OVER (PARTITION BY c) AS ended FROM paths),
nodes AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, max(size) AS size, substring(path, 1, 64 * (d - 1)) AS above,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ended), '')) AS ends_sha256
  FROM members GROUP BY path, d),
children AS (SELECT above AS path, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY above, d),
sized AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN children k ON k.path = n.path AND k.d = n.d),
below AS (
  SELECT substring(path, 1, 64 * a) AS path, a AS d, count(*) FILTER (n_children = 0) AS n_leaves,
         CAST(sum((n_convs - 1) * size) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM sized) GROUP BY ALL)
SELECT s.conv_id, CAST(s.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, s.n_convs, s.n_children, b.n_leaves,
       b.saved_tokens, s.ends_sha256
FROM sized s JOIN below b ON b.path = s.path AND b.d = s.d
LEFT JOIN nodes p ON p.path = s.above AND p.d = s.d - 1"""


ORACLES = {
    "op3_exact_dedup": EXACT_COPIES,
    "op5_topk": TOP_K,
    "op11_centroids": lloyd(),
    "op12_decontamination": benchmark_hits(),
    "op13_prefix_trie": prefix_nodes(),
}
