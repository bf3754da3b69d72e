"""SQL of the queries that SQL can express (run by DuckDB over the same tables)."""

# Words are runs of characters other than 0x20 and 0x09-0x0D.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

NGRAM_JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
  FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * o >= 75 * (x.n + y.n - o)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, s.b FROM reach r JOIN sides s ON s.a = r.other)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, (SELECT min(other) FROM reach r WHERE r.doc_id = w.doc_id) AS component_id
FROM w LEFT JOIN sizes ON sizes.doc_id = w.doc_id
"""

SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS k FROM w, unnest(range(1, greatest(len(ws) - 18, 1))) AS t(i)),
later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS LAST, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM later, unnest(range(0, 20)) AS t(j)),
words AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) AS t(p)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

TOP_K_SEARCH = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))
SELECT a.vec_id AS query_id,
       CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY list_inner_product(a.q, b.q) DESC, b.vec_id) AS INTEGER) AS rank,
       b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
WHERE a.vec_id % 50 = 0
QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY list_inner_product(a.q, b.q) DESC, b.vec_id) <= 5
"""

SUFFIX_DEDUP = """
WITH b AS (SELECT doc_id, encode(coalesce(text, '')) AS t, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
windows AS (SELECT doc_id, i, md5(t[i:i + 399]) AS k FROM b, unnest(range(1, greatest(n - 398, 1))) AS u(i)),
starts AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY k) > 1),
steps AS (
  SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 400, true) AS new FROM starts),
runs AS (
  SELECT doc_id, i, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM steps),
spans AS (SELECT doc_id, run, min(i) AS s, max(i) + 399 AS e FROM runs GROUP BY doc_id, run),
totals AS (SELECT doc_id, sum(e - s + 1) AS gone, count(*) AS k FROM spans GROUP BY doc_id),
edges AS (SELECT doc_id, 0 AS e, 0 AS run FROM b UNION ALL SELECT doc_id, e, run FROM spans),
pieces AS (
  SELECT edges.doc_id, edges.e + 1 AS lo, coalesce(spans.s - 1, b.n) AS hi, t
  FROM edges JOIN b ON b.doc_id = edges.doc_id
  LEFT JOIN spans ON spans.doc_id = edges.doc_id AND spans.run = edges.run + 1),
kept AS (
  SELECT doc_id, string_agg(CASE WHEN hi >= lo THEN hex(t[lo:hi]) ELSE '' END, '' ORDER BY lo) AS h FROM pieces GROUP BY doc_id)
SELECT b.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(k, 0) AS BIGINT) AS n_spans, sha256(unhex(h)) AS kept_sha256
FROM b JOIN kept ON kept.doc_id = b.doc_id LEFT JOIN totals ON totals.doc_id = b.doc_id
"""

EXACT_DEDUP = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents),
g AS (SELECT s, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY s)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(s) AS text_sha256 FROM t JOIN g USING (s)
"""
