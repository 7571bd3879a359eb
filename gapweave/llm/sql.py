"""SQL of the queries that another engine can express."""

QUALITY_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
),
split AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM docs
),
windows AS (
  SELECT r, unnest(range(1, len(w) - 6)) AS i, w FROM split WHERE len(w) >= 8
),
counted AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, list_slice(w, i, i + 7)) AS n FROM windows
),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM counted WHERE n >= 2) AS x GROUP BY r
),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(l) AS n_lines,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters
  FROM split LEFT JOIN covered AS c USING (r)
),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 50 * n_lines
            OR 100 * n_stutters > 30 * n_words OR word_chars < 2 * n_words OR word_chars > 40 * n_words) AS kept
FROM judged
"""

CHAT_SQL = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(t, r)
),
measured AS (
  SELECT *, length(regexp_replace(replace(text, '\', '\\'),
           '(<</SYS>>|<<SYS>>|\[ANSWER\]|\[/INST\]|\[/ROLE\]|\[/TURN\]|\[INST\]|\[ROLE\]|\[TURN\]|</s>|<s>)', '\1+', 'g')) AS n_text,
         length(regexp_replace(replace(role, '\', '\\'),
           '(<</SYS>>|<<SYS>>|\[ANSWER\]|\[/INST\]|\[/ROLE\]|\[/TURN\]|\[INST\]|\[ROLE\]|\[TURN\]|</s>|<s>)', '\1+', 'g')) AS n_role
  FROM turns
),
framed AS (
  SELECT *, n_text + CASE role WHEN 'system' THEN 8 + 9 WHEN 'user' THEN 7 + 8 WHEN 'assistant' THEN 9 + 5
                     ELSE 7 + n_role + 8 + 7 + 8 END AS n_formatted
  FROM measured
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (sum(n_formatted) + 3)::BIGINT AS formatted_chars,
       regexp_full_match(string_agg(role || ',', '' ORDER BY turn NULLS FIRST, role, text),
                         '(system,)?(user,assistant,)*(user,)?') AS valid
FROM framed GROUP BY conv_id
"""

EMBEDDINGS_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
),
usable AS (
  SELECT vec_id, e FROM vectors
  WHERE vec_id IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
),
near AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable AS a JOIN usable AS b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
),
reach AS (
  SELECT a, b FROM near
  UNION
  SELECT r.a, n.b FROM reach AS r JOIN near AS n ON r.b = n.a
),
joined AS (
  SELECT v.vec_id, (SELECT count(*) FROM near WHERE a = v.vec_id)::BIGINT AS n_links,
         least(v.vec_id, coalesce((SELECT min(b) FROM reach WHERE a = v.vec_id), v.vec_id))::BIGINT AS component_id
  FROM vectors AS v
)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM joined
"""

LEAKS_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
items AS (
  SELECT item_id::VARCHAR AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0) AS x
),
lengths AS (SELECT DISTINCT n FROM windows),
passages AS (
  SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n) AS x
),
hits AS (SELECT r, i, n, item FROM passages JOIN windows USING (n, g)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) AS x GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT r, item FROM hits) AS x GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

NEGATIVES_SQL = r"""
WITH rows_ AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
),
scored AS (
  SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM rows_ AS a, rows_ AS b WHERE a.id % 50 = 0 AND a.id <> b.id
),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
