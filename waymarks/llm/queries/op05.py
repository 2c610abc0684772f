"""The language of every document."""

from waymarks.llm.langid import identify
from waymarks.llm.registry import query, table


@query("op5_language_id")
def op5(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))
