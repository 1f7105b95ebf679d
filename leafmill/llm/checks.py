"""DuckDB SQL for the operators whose rows SQL can state, each over the whole given tables."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

WARC = """
WITH p AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS bytes, sha1(coalesce(html, '')) AS digest FROM pages
), g AS (
  SELECT digest, max(page_id) AS keeper FROM p WHERE bytes >= 1000 GROUP BY digest
)
SELECT page_id, url, bytes AS payload_bytes, digest AS payload_digest,
       CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM p LEFT JOIN g USING (digest)
"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
runs AS (
  SELECT doc_id, s, array_to_string(w[s : s + 34], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)
), again AS (
  SELECT run FROM runs GROUP BY run HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM runs JOIN again USING (run)
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

NGRAM_JOIN = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END) AS shingle
  FROM d
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * common >= 75 * (p.n + q.n - common)
), reach(x, y) AS (
  SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(reach.y), d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.x = d.doc_id GROUP BY d.doc_id
"""

NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND NOT coalesce(list_bool_or(list_transform(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))), false)
), a AS (
  SELECT vec_id AS anchor_id, label AS a_label, vec AS a_vec FROM v WHERE vec_id % 50 = 0
), s AS (
  SELECT anchor_id, a_label, vec_id, label,
         coalesce(list_sum(list_transform(list_zip(a_vec, vec), lambda t: coalesce(t[1] * t[2], 0))), 0) AS score
  FROM a, v
), pos AS (
  SELECT anchor_id, a_label, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r
        FROM s WHERE label = a_label AND vec_id <> anchor_id)
  WHERE r <= 5
), neg AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM pos p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.a_label
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
"""

CHECKS = {"op12_negatives": NEGATIVES, "op7_warc": WARC, "op8_ngram_join": NGRAM_JOIN, "op10_substrings": SUBSTRINGS}
