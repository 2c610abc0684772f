"""A mix of all documents by source weights."""

from waymarks.llm.mixing import Mix
from waymarks.llm.registry import query, table


@query("op7_source_mix")
def op7(spark, sf_dir):
    mix = Mix(table(spark, sf_dir, "documents"))
    return mix.taken().select("doc_id", "size", "source_size", "target", "taken", "source")
