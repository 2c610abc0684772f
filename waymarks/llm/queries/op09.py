"""Substring dedup over all documents."""

from pyspark.sql import functions as F

from waymarks.llm.registry import query, table
from waymarks.llm.substrings import remove_repeats

SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM starts
), firsts AS (
  SELECT h, min(doc_id) AS first FROM windows GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
  FROM windows JOIN firsts USING (h) WHERE doc_id > first
), marked AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN ps IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
    list_transform(list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(ps, j)),
                   lambda j: w[j]), ' ') END) AS kept_sha256
FROM words LEFT JOIN marked USING (doc_id)
"""


@query("op9_substring_dedup", SQL)
def op9(spark, sf_dir):
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
