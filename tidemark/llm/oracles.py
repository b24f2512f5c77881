"""SQL for the queries that SQL can express: the same rows by plain joins, for small tables."""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
  FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS m FROM sets),
linked AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM members a JOIN members b ON a.m = b.m AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reached r JOIN linked l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.c AS component_id, s.doc_id = r.c AS kept
FROM sets s JOIN (SELECT a, min(b) AS c FROM reached GROUP BY a) r ON r.a = s.doc_id
"""

TOP_K = """
WITH vectors AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum([q.v[i] * c.v[i] FOR i IN generate_series(1, len(q.v))]) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

MIXING = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(CAST(doc_id AS VARCHAR)) AS mark
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) AS place
  FROM docs GROUP BY source),
weighed AS (
  SELECT *, CAST([5, 2, 1][(place - 1) % 3 + 1] AS DOUBLE) AS weight, CAST(2 * source_size AS DOUBLE) AS most,
         1.5 * CAST(sum(source_size) OVER () AS DOUBLE) AS budget
  FROM sources),
filled AS (
  SELECT *, row_number() OVER (ORDER BY most / weight, place) AS k FROM weighed),
rates AS (
  SELECT *, (budget - coalesce(sum(most) OVER earlier, 0)) / sum(weight) OVER later AS rate
  FROM filled
  WINDOW earlier AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         later AS (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
chosen AS (SELECT rate FROM rates WHERE most > rate * weight ORDER BY k LIMIT 1),
targets AS (
  SELECT f.source, f.source_size, f.place, f.budget,
         CASE WHEN (SELECT rate FROM chosen) IS NULL THEN f.most
              ELSE least(f.most, (SELECT rate FROM chosen) * f.weight) END AS target
  FROM filled f),
queued AS (
  SELECT d.doc_id, d.size, t.source_size, t.place, t.target, t.budget, d.mark, round,
         CASE WHEN t.target > 0 THEN (round * t.source_size + sum(d.size) OVER (
           PARTITION BY d.source, round ORDER BY d.mark ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / t.target
              ELSE 0 END AS finish
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) r(round)),
summed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, place, mark ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
  FROM queued)
SELECT doc_id, size, source_size, target, CAST(sum(CASE WHEN total <= budget THEN size ELSE 0 END) AS BIGINT) AS taken
FROM summed GROUP BY doc_id, size, source_size, target
"""
