"""Source divergence audit over all documents."""

from waymarks.llm.divergence import source_divergence
from waymarks.llm.registry import query, table

SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(text, '') AS text FROM documents
), tokens AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM docs
), kept AS (
  SELECT lang, t FROM tokens GROUP BY ALL HAVING count(DISTINCT r) >= 30
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), vocabulary AS (
  SELECT lang, count(t) AS v FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang)
  GROUP BY lang
), counts AS (
  SELECT lang, source, t, count(*) AS c FROM tokens SEMI JOIN kept USING (lang, t) GROUP BY ALL
), grid AS (
  SELECT lang, source, t, coalesce(c, 0) AS c FROM groups JOIN kept USING (lang)
  LEFT JOIN counts USING (lang, source, t)
), shares AS (
  SELECT lang, source, t, c, 1 + (1000000000::HUGEINT * (c + 5)) //
    (sum(c) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM grid JOIN vocabulary USING (lang)
), lang_shares AS (
  SELECT lang, t, 1 + (1000000000::HUGEINT * (c + 5)) //
    (sum(c) OVER (PARTITION BY lang) + 5 * v) AS q
  FROM (SELECT lang, t, sum(c) AS c FROM grid GROUP BY ALL) JOIN vocabulary USING (lang)
), parted AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y USING (lang, t)
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', t, p - q FROM shares JOIN lang_shares USING (lang, t)
  WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS k
  FROM parted
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(k AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR k <= 50
"""


@query("op13_source_divergence", SQL)
def op13(spark, sf_dir):
    return source_divergence(table(spark, sf_dir, "documents"))
