"""Near-duplicates among all vectors."""

from waymarks.llm.embeddings import near_duplicates
from waymarks.llm.registry import query, table


@query("op2_pstable_embeddings")
def op2(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))
