"""DuckDB SQL for the registered queries."""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
firsts AS (SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT k.*, f.first_doc IS NOT NULL AND k.doc_id > f.first_doc AS gone FROM keyed k LEFT JOIN firsts f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

JACCARD_JOIN = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(generate_series(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * common >= 90 * (x.n + y.n - common)),
sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, s.b FROM reach r JOIN sides s ON r.b = s.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5('0:' || doc_id) AS place
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM d GROUP BY source),
ranked AS (
  SELECT *, sum(w) OVER (ORDER BY 3.0::DOUBLE * source_size / w DESC, source DESC NULLS FIRST) AS w_left,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
           ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_left
  FROM s),
shares AS (SELECT *, words_left::DOUBLE / w_left::DOUBLE AS share FROM ranked),
lowest AS (SELECT share FROM shares WHERE share * w <= 3 * source_size ORDER BY words_left DESC LIMIT 1),
t AS (
  SELECT s.source, s.source_size,
         CASE WHEN l.share * w > 3 * source_size THEN (3 * source_size)::DOUBLE ELSE l.share * w END AS target
  FROM s, lowest l),
p AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d)
SELECT p.doc_id, p.size, t.source_size, t.target,
       (p.size * len(list_filter([0, 1, 2], lambda k: 2 * (k * t.source_size + p.start) + p.size < 2 * floor(t.target + 0.5))))::BIGINT AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""

EMBEDDING_DEDUP = r"""
WITH RECURSIVE sound AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM embeddings v
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) n USING (vec_id)
JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) c USING (vec_id)
"""

SUBSTRING_DEDUP = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (
  SELECT doc_id, unnest(generate_series(0, length(h) // 2 - 400)) AS p, h FROM d WHERE length(h) >= 800),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 800)) AS w FROM s),
r AS (SELECT doc_id, p FROM w WHERE w IN (SELECT w FROM w GROUP BY w HAVING count(*) > 1)),
g AS (
  SELECT *, CASE WHEN p > 400 + lag(p) OVER (PARTITION BY doc_id ORDER BY p) THEN 1 ELSE 0 END AS new_span FROM r),
spans AS (
  SELECT doc_id, n, min(p) AS a, max(p) + 400 AS b
  FROM (SELECT *, sum(new_span) OVER (PARTITION BY doc_id ORDER BY p) AS n FROM g) GROUP BY doc_id, n),
gaps AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_byte FROM spans),
parts AS (
  SELECT doc_id, from_byte, a AS to_byte FROM gaps
  UNION ALL
  SELECT d.doc_id, coalesce(max(s.b), 0), length(any_value(d.h)) // 2 FROM d LEFT JOIN spans s USING (doc_id) GROUP BY d.doc_id),
kept AS (
  SELECT p.doc_id, string_agg(substr(d.h, 2 * from_byte + 1, 2 * (to_byte - from_byte)), '' ORDER BY from_byte, to_byte) AS h
  FROM parts p JOIN d USING (doc_id) GROUP BY p.doc_id)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, coalesce(n.n_removed, 0)::BIGINT AS n_removed, coalesce(n.n_spans, 0) AS n_spans,
       sha256(unhex(k.h)) AS kept_sha256
FROM d JOIN kept k USING (doc_id)
LEFT JOIN (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id) n USING (doc_id)
"""

LEXICAL_SEARCH = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM i JOIN p USING (term) JOIN w USING (term) JOIN d USING (doc_id), s GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
