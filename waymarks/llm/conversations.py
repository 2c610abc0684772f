"""Chat formatting: collapse cumulative snapshots, then render; DataFrame operations only.

Logs often hold a conversation many times, once after each turn.  Every turn gets a rolling hash of all
turns so far.  A conversation whose last hash is the hash of an earlier turn of another one is a
prefix of it and goes (an anti-join); of equal conversations the smallest conv_id stays.  What is left is
rendered with markers around each turn.

A rolling hash is the pair of running sums of two hashes of (position, role, text).  Conversations
are cut into parts by position before anything runs in order, so a conversation of any length is
never one task's work, and its rendering comes in parts of a bounded number of turns.

Defined results: rows without conv_id belong to no conversation and are left out.  Turns order by turn
(NULL last), role, text; equal turn numbers and repeated rows count as turns of their own.  A NULL role
renders as ``unknown``, a NULL text as empty, but neither equals a conversation that has the value
written out.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymarks.llm.stored import stored

#: Turns rendered in one row.
PART_TURNS = 256
#: Consecutive turn numbers that are ordered in one group.
RANGE = 1024
#: Hashes of turns are 40 bits each, so sums of 8 million of them fit.
MODULUS = 1 << 40

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _positions(turns: DataFrame) -> DataFrame:
    """Number the turns of each conversation from 0, range by range of turn numbers."""
    rows = turns.withColumn(
        "_range", F.coalesce(F.floor(F.col("turn") / RANGE), F.lit((1 << 63) - 1).cast("bigint"))
    )
    sizes = rows.groupBy("conv_id", "_range").count()
    earlier = Window.partitionBy("conv_id").orderBy("_range")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "conv_id", "_range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before")
    )
    inner = Window.partitionBy("conv_id", "_range").orderBy(
        F.asc_nulls_last("turn"), F.asc_nulls_last("role"), F.asc_nulls_last("text")
    )
    at = F.row_number().over(inner) - 1
    rows = rows.withColumn("_at", at).join(sizes, ["conv_id", "_range"])
    return rows.select("conv_id", "role", "text", (F.col("_before") + F.col("_at")).alias("position"))


def prefix_hashes(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, part, position, role, text, h1, h2): the hashes cover all turns up to this one."""
    rows = _positions(turns.select("conv_id", "turn", "role", "text").where("conv_id IS NOT NULL"))
    part = F.floor(F.col("position") / part_turns)

    def mixed(seed: int) -> Column:
        # NULLs hash like nothing else: xxhash64 skips them, so say which they are.
        null = F.col("role").isNull().cast("int") * 2 + F.col("text").isNull().cast("int")
        of = F.xxhash64(F.lit(seed), "position", null, "role", F.lit(0), "text")
        return F.pmod(of, F.lit(MODULUS))

    rows = rows.withColumns({"part": part, "t1": mixed(1), "t2": mixed(2)})
    sums = rows.groupBy("conv_id", "part").agg(F.sum("t1").alias("s1"), F.sum("t2").alias("s2"))
    earlier = Window.partitionBy("conv_id").orderBy("part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "conv_id",
        "part",
        *(F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(b) for s, b in (("s1", "b1"), ("s2", "b2"))),
    )
    inner = Window.partitionBy("conv_id", "part").orderBy("position")
    inner = inner.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"r1": F.sum("t1").over(inner), "r2": F.sum("t2").over(inner)})
    rows = rows.join(sums, ["conv_id", "part"])
    return rows.select(
        "conv_id",
        "part",
        "position",
        "role",
        "text",
        (F.col("r1") + F.col("b1")).alias("h1"),
        (F.col("r2") + F.col("b2")).alias("h2"),
    )


def maximal(hashed: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that are no prefix of a longer or earlier one."""
    # A prefix hash of many conversations is one row.
    prefixes = hashed.groupBy("position", "h1", "h2").agg(
        F.max("last").alias("longest"), F.min(F.when(F.col("position") == F.col("last"), F.col("conv_id"))).alias("first")
    )
    ends = hashed.where(F.col("position") == F.col("last"))
    ends = ends.select("conv_id", "position", "h1", "h2")
    covered = prefixes.select(
        F.col("position").alias("_p"),
        F.col("h1").alias("_h1"),
        F.col("h2").alias("_h2"),
        "longest",
        "first",
    )
    covers = (
        (F.col("position") == F.col("_p"))
        & (F.col("h1") == F.col("_h1"))
        & (F.col("h2") == F.col("_h2"))
        & ((F.col("longest") > F.col("position")) | (F.col("first") < F.col("conv_id")))
    )
    kept = ends.join(covered, covers, "left_anti")
    return kept.select("conv_id", (F.col("position") + 1).alias("n_turns"))


def render(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, part, n_turns, text) of the maximal conversations, part by part.

    Parts in turn are the whole rendering; ``n_turns`` counts the turns of the conversation.
    """
    hashed = prefix_hashes(turns, part_turns)
    lasts = hashed.groupBy("conv_id").agg(F.max("position").alias("last"))
    hashed = stored(hashed.join(lasts, "conv_id"), "turns")
    kept = maximal(hashed)
    role, text = F.coalesce("role", F.lit("unknown")), F.coalesce("text", F.lit(""))
    line = F.concat(F.lit(OPEN), role, F.lit("\n"), text, F.lit(CLOSE + "\n"))
    lines = hashed.select("conv_id", "part", "position", line.alias("line"))
    lines = lines.join(kept, "conv_id")
    joined = F.array_sort(F.collect_list(F.struct("position", "line")))
    return lines.groupBy("conv_id", "part").agg(
        F.first("n_turns").alias("n_turns"),
        F.array_join(F.transform(joined, lambda x: x["line"]), "").alias("text"),
    )
