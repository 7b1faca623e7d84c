"""DuckDB SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

OP1 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.first_doc AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)
), found AS (
  SELECT p.doc_id, p.n, p.i, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.win = x.win
), hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP4 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         substr(md5('mix' || CAST(doc_id AS VARCHAR)), 1, 16) AS h
  FROM documents
), sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS source_no FROM sizes
), weighted AS (
  SELECT *, [5, 2, 1][CAST((source_no - 1) % 3 AS INT) + 1] AS weight, source_size * 2 AS fill FROM numbered
), levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 - coalesce(CAST(sum(fill) OVER before AS DOUBLE), 0))
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM weighted
  WINDOW before AS (ORDER BY CAST(fill AS DOUBLE) / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_no, source_size, least(CAST(fill AS DOUBLE), weight * max(level) OVER ()) AS target FROM levels
), queued AS (
  SELECT d.*, t.source_no, t.source_size, t.target, sum(d.size) OVER (PARTITION BY t.source_no ORDER BY d.h) AS cum
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), items AS (
  SELECT *, CAST(copy * source_size + cum AS DOUBLE) / target AS finish
  FROM queued, (SELECT unnest([0, 1]) AS copy) WHERE size > 0
), listed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source_no, h, copy) AS total FROM items
), taken AS (
  SELECT doc_id, sum(size) AS taken FROM listed WHERE total <= (SELECT 1.5 * sum(source_size) FROM sizes) GROUP BY doc_id
)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(k.taken, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN taken k USING (doc_id)
"""

OP9 = r"""
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS INTEGER) AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP2 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(15 + length(replace(replace(replace(role, '\', '\\'), '<', '\<'), chr(10), '\n'))
                + length(replace(replace(text, '\', '\\'), '<', '\<'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

OP7 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(4, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)
), edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM d
  UNION
  SELECT r.node, e.b FROM reach r JOIN edge e ON r.seen = e.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN size USING (doc_id)
JOIN (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node) USING (doc_id)
"""

OP13 = r"""
WITH d AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM documents
), b AS (
  SELECT item_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM benchmark
), size AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
total AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM size),
length AS (SELECT doc_id, 100 - 75 + ((75 * n * big_n) // big_l) AS m FROM size, total),
posting AS (SELECT term, doc_id, count(*) AS tf FROM d WHERE term IN (SELECT term FROM b) GROUP BY term, doc_id),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM posting, total GROUP BY term
), score AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM b JOIN posting USING (term) JOIN weight USING (term) JOIN length USING (doc_id) GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM score WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
