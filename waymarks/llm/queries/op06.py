"""Class-based n-gram scores of all documents."""

from waymarks.llm.classlm import class_scores, held_out
from waymarks.llm.registry import query, table


@query("op6_class_ngrams")
def op6(spark, sf_dir):
    return class_scores(table(spark, sf_dir, "documents"), held_out(2, 7))
