"""SQL for operators whose results SQL can state over whole tables (DuckDB)."""

from __future__ import annotations

JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]
                                          FOR i IN range(1, len(w) - 1)]) END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT one.doc_id AS a, two.doc_id AS b, count(*) AS common, any_value(one.n) AS n_a, any_value(two.n) AS n_b
  FROM items one JOIN items two ON one.x = two.x AND one.doc_id <> two.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 90 * (n_a + n_b - common)),
reach AS (
  SELECT DISTINCT a, a AS b FROM links
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, coalesce(root, doc_id) AS component_id
FROM sets LEFT JOIN roots ON doc_id = a
"""

EMBEDDINGS = r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (
  SELECT *, sqrt(list_dot_product(e, e)) AS size FROM vectors
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT one.vec_id AS a, two.vec_id AS b FROM usable one
  JOIN usable two ON one.label = two.label AND one.vec_id <> two.vec_id AND len(one.e) = len(two.e)
  WHERE list_dot_product(one.e, two.e) / (one.size * two.size) >= 0.93),
reach AS (
  SELECT DISTINCT a, a AS b FROM links
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id,
       coalesce(root, vec_id) = vec_id AS kept
FROM vectors LEFT JOIN roots ON vec_id = roots.a LEFT JOIN degrees ON vec_id = degrees.a
"""
