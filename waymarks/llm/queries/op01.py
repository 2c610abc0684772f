"""Documents that hold passages of the benchmark."""

from waymarks.llm.decontaminate import contaminated, overlaps
from waymarks.llm.registry import query, table


@query("op1_spaced_seeds")
def op1(spark, sf_dir):
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contaminated(overlaps(docs, benchmark))
