"""Suffix-array dedup over all documents."""

from pyspark.sql import functions as F

from waymarks.llm.registry import query, table
from waymarks.llm.repeats import remove_repeated_bytes

SQL = r"""
WITH bytes AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), sizes AS (
  SELECT r, doc_id, h, length(h) // 2 AS n FROM bytes
), windows AS (
  SELECT r, i, md5_number(substr(h, 2 * i + 1, 400)) AS w
  FROM (SELECT r, h, unnest(range(0, n - 199)) AS i FROM sizes WHERE n >= 200)
), repeated AS (
  SELECT r, i FROM windows JOIN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1) USING (w)
), runs AS (
  SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS run FROM (
    SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS opens
    FROM repeated)
), spans AS (
  SELECT r, min(i) AS a, max(i) + 200 AS b FROM runs GROUP BY r, run
), pieces AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS p, a AS q FROM spans
  UNION ALL
  SELECT r, coalesce(max(b), 0), max(n) FROM sizes LEFT JOIN spans USING (r) GROUP BY r
), kept AS (
  SELECT r, string_agg(substr(h, 2 * p + 1, 2 * (q - p)), '' ORDER BY p) AS h
  FROM pieces JOIN sizes USING (r) GROUP BY r
), removed AS (
  SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM sizes JOIN kept USING (r) LEFT JOIN removed USING (r)
"""


@query("op11_suffix_dedup", SQL)
def op11(spark, sf_dir):
    kept = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
