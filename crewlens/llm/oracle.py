"""The SQL (DuckDB) that queries of this subpackage are checked with."""

QUERIES: dict[str, str] = {}

QUERIES["op6_chat_formatting"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), written AS (
  SELECT *,
    replace(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'), '<|', '<\|') AS content,
    replace(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'), '<|', '<\|'), ':', '\c') AS name
  FROM said
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, name, content)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, name, content) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(4 + length(name) + 2 + length(content) + 9)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""

_STOP_WORDS = """
the of and to in is that with for as was on by it
de la le les des et en un une du que qui pour dans
der die und das den von zu mit ist nicht ein eine im
el los las y se del una con por su para al lo
"""

QUERIES["op10_quality_rules"] = rf"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), parted AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM base
), word AS (
  SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM parted
), win AS (
  SELECT r, i, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM word WINDOW o AS (PARTITION BY r ORDER BY i)
), again AS (
  SELECT r, unnest(list(i)) AS i FROM win WHERE z IS NOT NULL GROUP BY r, x, y, z HAVING count(*) > 1
), covered AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY r
), measured AS (
  SELECT p.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    len(list_filter(w, lambda x: list_contains({_STOP_WORDS.split()}, x)))::BIGINT AS n_stop_words,
    len(l)::BIGINT AS n_lines,
    len(list_filter(l, lambda x: x = upper(x) AND x <> lower(x)))::BIGINT AS n_shouted_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM parted p LEFT JOIN covered c USING (r)
), ruled AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    list_filter([
      CASE WHEN word_chars / nullif(n_words, 0) NOT BETWEEN 2 AND 14 THEN 'mean_word_length' END,
      CASE WHEN n_symbols / nullif(n_words, 0) > 0.25 THEN 'symbols_per_word' END,
      CASE WHEN n_stop_words / nullif(n_words, 0) < 0.01 THEN 'stop_words_per_word' END,
      CASE WHEN n_dup_lines / nullif(n_lines, 0) > 0.6 THEN 'repeated_lines' END,
      CASE WHEN n_shouted_lines / nullif(n_lines, 0) > 0.6 THEN 'shouted_lines' END
    ], lambda x: x IS NOT NULL) AS broken
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, n_lines,
  n_shouted_lines, base_failed, array_to_string(broken, ',') AS broken_rules,
  NOT base_failed AND len(broken) = 0 AS kept
FROM ruled
"""

QUERIES["op12_hard_negatives"] = """
WITH seen AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda c: c IS NOT NULL AND isfinite(c)))
), met AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.x, c.x)::BIGINT AS score
  FROM seen a JOIN seen c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM met WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN met USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
