"""Secrets in every document."""

from pyspark.sql import functions as F

from waymarks.llm.registry import query, table
from waymarks.llm.secrets import scan


def _joined(spans):
    text = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(text, ",")


@query("op3_secret_scan")
def op3(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "random")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
