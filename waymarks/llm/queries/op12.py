"""Ranked lexical search of every benchmark item over all documents."""

from waymarks.llm.registry import query, table
from waymarks.llm.search import rank_documents

SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), sizes AS (
  SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs
), tf AS (
  SELECT doc_id, n, t, count(*) AS tf
  FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS t FROM docs) GROUP BY ALL
), asked AS (
  SELECT item_id, t, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
), weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, sizes GROUP BY t, n_docs
), scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) //
    (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (t) JOIN tf USING (t), sizes GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS k
  FROM scores WHERE score > 0
)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score FROM ranked WHERE k <= 10
"""


@query("op12_ranked_search", SQL)
def op12(spark, sf_dir):
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
