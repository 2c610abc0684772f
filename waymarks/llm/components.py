"""Connected components of a link table by repeated contraction, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymarks.llm.stored import stored


def _follow(df: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """Replace a node by its parent where it has one."""
    to = parents.select(F.col("node").alias("_node"), F.col("parent").alias("_parent"))
    joined = df.join(to, df[column] == to["_node"], "left")
    return joined.withColumn(column, F.coalesce("_parent", column)).drop("_node", "_parent")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v); the component is its smallest node.

    In each round a node points to its smallest neighbour if that is smaller, pointers are followed
    twice more, and nodes contract to where they point.  Pointers only descend, so there are no
    cycles; a path shrinks to a fraction in each round.  Self links are fine, NULL ends are ignored.
    """
    given = edges.where("u IS NOT NULL AND v IS NOT NULL")
    left = stored(given.select("u", "v").distinct(), "edges")
    nodes = left.select(F.col("u").alias("node")).union(left.select("v")).distinct()
    labels = nodes.withColumn("component", F.col("node"))
    left = left.where("u <> v")
    while not left.isEmpty():
        both = left.union(left.select("v", "u"))
        parents = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("parent"))
        parents = stored(parents.where("parent < node"), "parents")
        parents = stored(_follow(_follow(parents, "parent", parents), "parent", parents), "jumps")
        labels = stored(_follow(labels, "component", parents), "labels")
        left = _follow(_follow(left, "u", parents), "v", parents)
        left = stored(left.where("u <> v").distinct(), "edges")
    return labels
