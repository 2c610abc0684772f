"""MinHash near-dedup over all documents."""

from waymarks.llm.minhash import near_duplicates
from waymarks.llm.registry import query, table

SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
  WHERE 100 * shared >= 75 * (x.n + y.n - shared)
), reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM words
  UNION SELECT reach.doc_id, v FROM reach JOIN links ON u = r
), least AS (
  SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
  doc_id = component_id AS kept
FROM words JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


@query("op10_minhash", SQL)
def op10(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
