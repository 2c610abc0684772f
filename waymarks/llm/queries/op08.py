"""Maximal conversations, rendered."""

from waymarks.llm.conversations import render
from waymarks.llm.registry import query, table

SQL = """
WITH numbered AS (
  SELECT conv_id, role, text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) - 1 AS position
  FROM conversations WHERE conv_id IS NOT NULL
), lines AS (
  SELECT conv_id, position, max(position) OVER (PARTITION BY conv_id) AS last,
    '<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '')
      || '<|im_end|>' || chr(10) AS line,
    coalesce('r' || role, 'n') || chr(0) || coalesce('t' || text, 'n') AS raw
  FROM numbered
), prefixes AS (
  SELECT *, string_agg(length(raw) || ':' || raw, '') OVER (
    PARTITION BY conv_id ORDER BY position) AS prefix FROM lines
), covered AS (
  SELECT prefix, position, max(last) AS longest,
    min(CASE WHEN position = last THEN conv_id END) AS first
  FROM prefixes GROUP BY prefix, position
), kept AS (
  SELECT conv_id, last + 1 AS n_turns FROM prefixes JOIN covered USING (prefix, position)
  WHERE position = last AND longest = last AND first = conv_id
)
SELECT conv_id, CAST(position // 256 AS BIGINT) AS part, CAST(n_turns AS BIGINT) AS n_turns,
  string_agg(line, '' ORDER BY position) AS text
FROM lines JOIN kept USING (conv_id) GROUP BY ALL
"""


@query("op8_snapshot_collapse", SQL)
def op8(spark, sf_dir):
    return render(table(spark, sf_dir, "conversations"))
