"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: A vector links with nothing unless it is whole, finite and not zero.
OP5 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id, vec_id AS other FROM v
  UNION SELECT r.vec_id, l.y FROM reach r JOIN links l ON r.other = l.x
), least AS (
  SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
), counted AS (
  SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x
)
SELECT v.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM v JOIN least l USING (vec_id) LEFT JOIN counted c USING (vec_id)
"""

OP8 = f"""
WITH d AS (
  SELECT doc_id, {WORDS} AS w FROM documents
), b AS (
  SELECT item_id, {WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, list_slice(w, k, k + least(10, len(w)) - 1) AS p, least(10, len(w)) AS size
  FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(k) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT doc_id, size, k, list_slice(w, k, k + size - 1) AS p
  FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(k) WHERE len(w) >= size
), hits AS (
  SELECT p.doc_id, p.k, p.size, n.item_id FROM places p JOIN windows n ON p.size = n.size AND p.p = n.p
), hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM hits, unnest(range(k, k + size)) AS t(j) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES = {"op5_embeddings": OP5, "op8_decontamination": OP8}
