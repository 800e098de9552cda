"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

LINE_DEDUP = r"""
WITH lined AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), placed AS (
  SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS pos FROM lined WHERE len(lines) >= 3
), windows AS (
  SELECT doc_id, pos, array_to_string(list_slice(lines, pos, pos + 2), chr(10)) AS win FROM placed
), ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth
  FROM windows WHERE regexp_matches(win, '\S')
), covered AS (
  SELECT DISTINCT doc_id, pos + k AS pos
  FROM ranked, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1
), single AS (
  SELECT doc_id, unnest(range(1, len(lines) + 1)) AS pos, unnest(lines) AS line FROM lined
), marked AS (
  SELECT single.doc_id, single.pos, line, covered.pos IS NOT NULL AS gone
  FROM single LEFT JOIN covered ON single.doc_id = covered.doc_id AND single.pos = covered.pos
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
    string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS stay
  FROM marked GROUP BY doc_id
)
SELECT documents.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines,
  coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(stay, '')) AS kept_sha256
FROM documents LEFT JOIN kept ON documents.doc_id = kept.doc_id
"""

NGRAM_JACCARD = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), placed AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS pos
  FROM split WHERE len(words) > 0
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, pos, pos + 4), ' ') AS shingle
  FROM placed
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)
), edges AS (
  SELECT x, y FROM links UNION SELECT y, x FROM links
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reached.doc_id, edges.y FROM reached JOIN edges ON reached.other = edges.x
)
SELECT documents.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles,
  min(other) AS component_id
FROM documents JOIN reached ON documents.doc_id = reached.doc_id
LEFT JOIN sizes ON documents.doc_id = sizes.doc_id
GROUP BY documents.doc_id
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words
  FROM pieces
), f1 AS (
  SELECT lang, word AS w1, count(*) AS n
  FROM (SELECT lang, unnest(words) AS word FROM split) GROUP BY ALL
), f2 AS (
  SELECT lang, p[1] AS w1, p[2] AS w2, count(*) AS n
  FROM (SELECT lang, unnest(list_transform(range(1, len(words)),
    lambda i: [words[i], words[i + 1]])) AS p FROM split)
  GROUP BY ALL
), f3 AS (
  SELECT lang, p[1] AS w1, p[2] AS w2, p[3] AS w3, count(*) AS n
  FROM (SELECT lang, unnest(list_transform(range(1, len(words) - 1),
    lambda i: [words[i], words[i + 1], words[i + 2]])) AS p FROM split)
  GROUP BY ALL HAVING count(*) >= 10
), totals AS (
  SELECT lang, sum(n)::BIGINT AS n FROM f1 GROUP BY lang
), longest AS (
  SELECT lang, w1, w2, max(n) AS n FROM (
    SELECT lang, w1, w2, n FROM f3 UNION ALL SELECT lang, w2, w3, n FROM f3) GROUP BY ALL
), cuts AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.n AS a, 1 AS k, x.n AS l, y.n AS r
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1
  JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
  LEFT JOIN longest g ON g.lang = f2.lang AND g.w1 = f2.w1 AND g.w2 = f2.w2
  WHERE f2.n >= 10 AND (g.n IS NULL OR 100 * g.n < 50 * f2.n)
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.n, 1, x.n, y.n
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1
  JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.n, 2, x.n, y.n
  FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2
  JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3
), scored AS (
  SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, score
  FROM lowest WHERE place = 1
)
SELECT ranked.lang, rank, phrase, a, l, r, totals.n, score
FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op5_line_dedup": LINE_DEDUP,
    "op7_ngram_jaccard": NGRAM_JACCARD,
    "op12_phrase_collocations": COLLOCATIONS,
}
