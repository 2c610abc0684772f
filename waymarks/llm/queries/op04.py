"""Main text of every page."""

from pyspark.sql import functions as F

from waymarks.llm.extract import extract
from waymarks.llm.registry import query, table


@query("op4_site_style_tree")
def op4(spark, sf_dir):
    texts = extract(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))
