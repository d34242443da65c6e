"""DuckDB SQL of the operators that SQL can express."""

# Row by row: repeated ids are one document, rows without an id are none.
_LINES = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), lines AS (
  SELECT row, doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM d
), keyed AS (
  SELECT row, doc_id, pos, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.row, k.doc_id, k.pos, k.line, (r.key IS NOT NULL AND coalesce(k.doc_id <> r.keeper, FALSE)) AS dropped
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY row, doc_id
"""

# A row without an id belongs to no group.
_EXACT = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, CASE WHEN doc_id IS NULL THEN 1 ELSE count(doc_id) OVER g END AS group_size,
       coalesce(doc_id = max(doc_id) OVER g, TRUE) AS kept, sha256(key) AS text_sha256
FROM t WINDOW g AS (PARTITION BY key, doc_id IS NULL)
"""

_MIX = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('7:' || coalesce(doc_id::VARCHAR, 'null')) AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size, 3 * source_size AS cap,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         row_number() OVER (ORDER BY source IS NULL, source) AS rank
  FROM s
), f AS (
  SELECT *,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS words_left,
    (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS weight_left
  FROM w
), g AS (
  SELECT *, weight * words_left > cap * weight_left AS clamped FROM f
), l AS (
  SELECT max(words_left::DOUBLE / weight_left) FILTER (WHERE NOT clamped) AS level FROM g
), t AS (
  SELECT source, source_size, CASE WHEN clamped THEN cap::DOUBLE ELSE weight * level END AS target FROM g, l
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 3 END AS whole,
         round(target)::BIGINT AS want FROM t
), c AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.whole, r.want - r.whole * r.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
       (whole * size + least(size, greatest(0, rest - before)))::BIGINT AS taken
FROM c
"""

_DECONTAMINATE = r"""
WITH d AS (
  SELECT row_number() OVER () AS number, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), spread AS (
  SELECT item_id, words, least(10, len(words)) AS n, unnest(range(0, len(words) - least(10, len(words)) + 1)) AS pos
  FROM b WHERE len(words) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(words[pos + 1 : pos + n], ' ') AS phrase FROM spread
), places AS (
  SELECT number, words, n, unnest(range(0, len(words) - n + 1)) AS pos
  FROM d, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n
), seen AS (
  SELECT number, n, pos, array_to_string(words[pos + 1 : pos + n], ' ') AS phrase FROM places
), hits AS (
  SELECT s.number, s.pos, s.n, w.item_id FROM seen s JOIN windows w ON s.phrase = w.phrase AND s.n = w.n
), covered AS (
  SELECT number, count(*) AS n_hit FROM (SELECT DISTINCT number, unnest(range(pos, pos + n)) FROM hits) GROUP BY number
), listed AS (
  SELECT number, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT number, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY number
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
       coalesce(l.n_items, 0)::BIGINT AS n_items, sha256(coalesce(l.items, '')) AS items_sha256,
       c.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered c ON d.number = c.number LEFT JOIN listed l ON d.number = l.number
"""

_HARD_NEGATIVES = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 3
"""

ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": _LINES,
    "op6_exact_dedup": _EXACT,
    "op9_mixing": _MIX,
    "op12_decontaminate": _DECONTAMINATE,
    "op13_hard_negatives": _HARD_NEGATIVES,
}
