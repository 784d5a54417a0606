"""DuckDB SQL for the results of the queries that SQL can express on whole tables."""

DECONTAMINATION = r"""
WITH item_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark),
doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents),
windows AS (
    SELECT DISTINCT item_id, width, array_to_string(ws[i:i + width - 1], ' ') AS gram
    FROM (SELECT item_id, ws, least(len(ws), 10) AS width, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i
          FROM item_words WHERE len(ws) > 0)),
widths AS (SELECT DISTINCT width FROM windows),
grams AS (
    SELECT doc_id, width, i, array_to_string(ws[i:i + width - 1], ' ') AS gram
    FROM (SELECT doc_id, ws, width, unnest(range(1, len(ws) - width + 2)) AS i FROM doc_words, widths)),
hits AS (SELECT doc_id, g.width, i, item_id FROM grams g JOIN windows w ON g.width = w.width AND g.gram = w.gram),
words_hit AS (
    SELECT doc_id, count(*) AS n_hit
    FROM (SELECT DISTINCT doc_id, unnest(range(i, i + width)) AS p FROM hits) GROUP BY doc_id),
items_hit AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""

SUBSTRINGS = r"""
WITH doc_words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS gram
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM doc_words)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) > 1),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(ws[p], ' ' ORDER BY p) AS words
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM doc_words) ANTI JOIN removed USING (doc_id, p)
    GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM doc_words LEFT JOIN kept USING (doc_id)
"""

WARC = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
first AS (SELECT payload, min(page_id) AS source FROM payloads WHERE strlen(payload) >= 100 GROUP BY payload)
SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN source <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN source <> page_id THEN source END AS refers_to
FROM payloads LEFT JOIN first USING (payload)
"""

EMBEDDINGS = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a, vectors b
    WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
reached AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a) USING (vec_id)
     LEFT JOIN counts ON vec_id = counts.a
"""

ORACLES = {
    "op3_decontamination": DECONTAMINATION,
    "op4_substrings": SUBSTRINGS,
    "op6_warc": WARC,
    "op9_embeddings": EMBEDDINGS,
}
