"""SQL twins, for DuckDB, of the training-data queries that SQL can express.

Each is written from the definition of the result: windows, shingles and scores one by
one, without blocks, prefixes or an index.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

WORD = r"[^\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '{WORD}')"


SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, {_words('text')} AS ws FROM documents),
wins AS (
  SELECT doc_id, p, md5(array_to_string(ws[p : p + 49], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM w)
),
firsts AS (SELECT k, min(doc_id) AS f FROM wins GROUP BY k),
late AS (SELECT doc_id, p FROM wins JOIN firsts USING (k) WHERE doc_id > f),
gone AS (SELECT DISTINCT doc_id, p + o AS pos FROM late, range(50) AS r(o)),
placed AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w
),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t
  FROM placed ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words,
       (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

NGRAM_JACCARD_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_words(f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')")} AS ws
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p : p + 4], ' ') AS t
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS p FROM w WHERE len(ws) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)
),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, b.y FROM reach r JOIN both_ways b ON b.x = r.other
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""

EXACT_TOP_K = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scores AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id,
       (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id, score
FROM scores
QUALIFY rank <= 5
"""

CHAT_FORMATTING = """
WITH said AS (
  SELECT false AS probe, conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL
  SELECT true, -1, turn, role, '<|im_end|><|im_start|>assistant ok'
  FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
),
e AS (
  SELECT *, replace(replace(text, '&', '&amp;'), '<|', '&lt;|') AS body,
         replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&nl;') AS head
  FROM said
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(head) + 1 + length(body) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY probe, conv_id
"""

MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, text, len({_words('text')})::BIGINT AS size FROM documents
),
totals AS (SELECT source, sum(size)::BIGINT AS size FROM sized GROUP BY source),
weighed AS (
  SELECT source, size, 3.0::DOUBLE * size AS ceiling,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM totals
),
levels AS (
  SELECT *, ceiling / weight AS ratio,
         (sum(size) OVER ()
          - coalesce(sum(ceiling) OVER (ORDER BY ceiling / weight, source NULLS FIRST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(weight) OVER (ORDER BY ceiling / weight, source NULLS FIRST
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
),
goals AS (
  SELECT source, size AS source_size,
         least(ceiling, weight * (SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio)) AS target
  FROM levels
),
drawn AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
         coalesce(sum(s.size) OVER (
           PARTITION BY s.source
           ORDER BY md5(concat_ws('|', '0', coalesce(s.doc_id::VARCHAR, '-'), coalesce(md5(s.text), '-')))
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END::BIGINT AS passes
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       (passes * size + greatest(0, least(size, floor(target - passes * source_size) - before)))::BIGINT AS taken
FROM drawn
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWERED = f"translate(coalesce({{}}, ''), '{ascii_uppercase}', '{ascii_lowercase}')"

RANKED_LEXICAL_SEARCH = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWERED.format('text')}, '{_TERM}') AS ts
  FROM documents
),
d2 AS (SELECT r, doc_id, ts, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
tot AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM d2),
tf AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, n, unnest(ts) AS term FROM d2) GROUP BY ALL
),
wt AS (
  SELECT term, floor(1000.0 * ln((2.0 * big_n + 2.0) / (2.0 * count(*) + 1.0)))::BIGINT AS w
  FROM tf, tot GROUP BY term, big_n
),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWERED.format('text')}, '{_TERM}')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
),
s AS (
  SELECT q.item_id, tf.r, tf.doc_id,
         sum(wt.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * tf.n * tot.big_n) // tot.big_l))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN wt USING (term), tot
  GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score,
         (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank
  FROM s WHERE score > 0 AND doc_id IS NOT NULL
) WHERE rank <= 50
"""
