"""The contracts that SQL can express, for DuckDB over the same tables."""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op4_source_mixture": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || left(md5('mixture-1:' || doc_id::VARCHAR), 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS weight FROM s),
p AS (
  SELECT *, row_number() OVER o AS k,
         sum(source_size) OVER () - 3 * (sum(source_size) OVER o - source_size) AS words_left,
         sum(weight) OVER () - (sum(weight) OVER o - weight) AS weight_left
  FROM w WINDOW o AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
l AS (
  SELECT arg_min(words_left::DOUBLE / weight_left::DOUBLE, k) AS level
  FROM p WHERE words_left::DOUBLE / weight_left::DOUBLE * weight <= 3 * source_size),
t AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, level * weight) AS target FROM w, l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t)
SELECT d.doc_id, d.size, r.source_size, r.target,
       (d.size * (floor(rate)::BIGINT + (draw < rate - floor(rate))::BIGINT))::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
""",
    "op5_top_k": r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.parts, v.parts) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.parts) = len(v.parts)
  WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
""",
    "op10_contamination": f"""
WITH i AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
win AS (
  SELECT item_id, words[k : k + least(10, len(words)) - 1] AS phrase
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS k FROM i WHERE len(words) > 0)),
phrases AS (SELECT DISTINCT item_id, phrase FROM win),
sizes AS (SELECT DISTINCT len(phrase) AS n FROM phrases),
d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS words FROM documents),
parts AS (
  SELECT row, k, n, words[k : k + n - 1] AS phrase
  FROM (SELECT row, words, n, unnest(range(1, len(words) - n + 2)) AS k FROM d, sizes WHERE len(words) >= n)),
found AS (SELECT row, k, n, item_id FROM parts JOIN phrases USING (phrase)),
hits AS (SELECT row, count(DISTINCT w) AS n_hit FROM (SELECT row, unnest(range(k, k + n)) AS w FROM found) GROUP BY row),
ids AS (
  SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (row) LEFT JOIN ids USING (row)
""",
}
