"""SQL with the same results, for the text operators that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

# Words are counted as in the operator; the draw goes through each source in the order of the hash.
SQL["op10_water_filling"] = r"""
WITH sized AS (
  SELECT doc_id, source,
         COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || COALESCE(doc_id::VARCHAR, '')), 1, 8))::BIGINT >> 2 AS place
  FROM documents
), by_source AS (
  SELECT source, SUM(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, 3 * source_size AS cap,
         row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS k
  FROM by_source
), leveled AS (
  SELECT *,
         SUM(source_size) OVER () - COALESCE(SUM(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_left,
         SUM(weight) OVER () - COALESCE(SUM(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_left
  FROM ordered
), clamping AS (
  SELECT *, cap * weight_left <= words_left * weight AS clamped FROM leveled
), targets AS (
  SELECT source, source_size,
         CASE WHEN clamped THEN cap::DOUBLE
              ELSE MAX(CASE WHEN NOT clamped THEN words_left::DOUBLE / weight_left::DOUBLE END) OVER () * weight END AS target
  FROM clamping
), shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN LEAST(floor(target / source_size)::BIGINT, 3) ELSE 0 END AS repeats
  FROM targets
), running AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.repeats, t.target - t.repeats * t.source_size AS fraction,
         SUM(s.size) OVER (PARTITION BY s.source ORDER BY s.place) AS through,
         SUM(s.size) OVER (PARTITION BY s.source, s.place) AS here
  FROM sized s JOIN shares t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (repeats + CASE WHEN fraction > 0 AND through - here / 2.0 <= fraction THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running
"""

# All pairs that share a token of their prefixes, verified on full sets; every earlier line counts.
SQL["op4_prefix_lines"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents
), worded AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, line_no) AS id, doc_id, line_no, line,
         list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS tokens
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), sets AS (SELECT tokens, MIN(id) AS id FROM (SELECT id, list_sort(tokens) AS tokens FROM worded) GROUP BY tokens
), tokens AS (SELECT id, len(tokens) AS n, unnest(tokens) AS token FROM sets
), ranked AS (
  SELECT id, n, token, row_number() OVER (PARTITION BY id ORDER BY df, token) AS position
  FROM tokens JOIN (SELECT token, COUNT(*) AS df FROM tokens GROUP BY token) USING (token)
), prefixes AS (SELECT * FROM ranked WHERE position <= n - (4 * n + 4) // 5 + 1
), pairs AS (
  SELECT DISTINCT a.id AS earlier, b.id AS later FROM prefixes a JOIN prefixes b
  ON a.token = b.token AND a.id < b.id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
), shared AS (
  SELECT later, len(list_intersect(x.tokens, y.tokens)) AS in_both, len(x.tokens) + len(y.tokens) AS total
  FROM pairs JOIN sets x ON x.id = earlier JOIN sets y ON y.id = later
), matched AS (SELECT DISTINCT later AS id FROM shared WHERE 5 * in_both >= 4 * (total - in_both)
), judged AS (
  SELECT w.doc_id, w.line_no, w.id <> s.id OR EXISTS (SELECT 1 FROM matched m WHERE m.id = s.id) AS removed
  FROM worded w JOIN sets s ON list_sort(w.tokens) = s.tokens
)
SELECT d.doc_id, COUNT(j.line_no)::BIGINT AS n_lines, COUNT(*) FILTER (WHERE j.removed)::BIGINT AS n_removed,
       sha256(COALESCE(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (WHERE l.line IS NOT NULL AND NOT COALESCE(j.removed, FALSE)), '')) AS kept_sha256
FROM documents d LEFT JOIN lines l ON l.doc_id IS NOT DISTINCT FROM d.doc_id
LEFT JOIN judged j ON j.doc_id IS NOT DISTINCT FROM l.doc_id AND j.line_no = l.line_no
GROUP BY d.doc_id
"""

# All windows of 20 words; the first of equal ones, by document and start, stays.
SQL["op9_suffix_groups"] = r"""
WITH texts AS (
  SELECT doc_id, COALESCE(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), windows AS (
  SELECT doc_id, start, array_to_string(words[start:start + 19], ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM texts WHERE len(words) >= 20)
), repeated AS (
  SELECT doc_id, start FROM windows QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id NULLS FIRST, start) > 1
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS place FROM repeated
), placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts
), kept AS (
  SELECT p.doc_id, COUNT(c.place)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY p.place) FILTER (WHERE c.place IS NULL) AS text
  FROM placed p LEFT JOIN covered c ON c.doc_id IS NOT DISTINCT FROM p.doc_id AND c.place = p.place GROUP BY p.doc_id
)
SELECT t.doc_id, len(t.words)::BIGINT AS n_words, COALESCE(k.n_removed, 0)::BIGINT AS n_removed, sha256(COALESCE(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.doc_id IS NOT DISTINCT FROM t.doc_id
"""

# One document stands for all of an equal set; any two that share a run of words are compared, and links are followed to their end.
SQL["op8_circulant_minhash"] = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, COALESCE(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')))) END AS runs
  FROM texts
), classes AS (
  SELECT runs, MIN(doc_id) AS node FROM sets WHERE len(runs) > 0 GROUP BY runs
), shared AS (
  SELECT a.node AS one, b.node AS other, ANY_VALUE(a.n) + ANY_VALUE(b.n) AS total, COUNT(*) AS in_both
  FROM (SELECT node, len(runs) AS n, unnest(runs) AS run FROM classes) a
  JOIN (SELECT node, len(runs) AS n, unnest(runs) AS run FROM classes) b
    ON a.run = b.run AND a.node < b.node AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
  GROUP BY a.node, b.node
), links AS (
  SELECT one, other FROM shared WHERE 100 * in_both >= 80 * (total - in_both)
), both_ways AS (SELECT one, other FROM links UNION ALL SELECT other, one FROM links
), reached AS (
  SELECT node AS one, node AS other FROM classes
  UNION SELECT r.one, l.other FROM reached r JOIN both_ways l ON l.one = r.other
), components AS (SELECT one AS node, MIN(other) AS component FROM reached GROUP BY one)
SELECT s.doc_id, len(s.runs)::BIGINT AS n_shingles, COALESCE(p.component, s.doc_id) AS component_id,
  COALESCE(p.component, s.doc_id) IS NOT DISTINCT FROM s.doc_id AS kept
FROM sets s LEFT JOIN classes c ON c.runs = s.runs AND len(s.runs) > 0 LEFT JOIN components p ON p.node = c.node
"""
