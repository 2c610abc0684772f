"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame operations only.

Each source's documents form one stream of words in a repeatable shuffled order, read twice at most.
The stream is cut into blocks of equal numbers of words.  Slots of the mix carry van der Corput
points; a point falls into the share of one source, and the slots of a source, ranked, take its
blocks in turn.  A source whose slots fall short of its target by discrepancy gets the missing ones
at the end, and its last block is cut, so that it gives its target, rounded to a word.

Running sums and ranks never pass one source through one task: rows are dealt to parts inside a
source, parts are summed first, and windows run inside a part.

Defined results: NULL text has size 0 and is in no block.  A NULL source is a source of its own,
after all others.  Rows without doc_id, and repeated rows, are documents of their own; equal rows
are interchangeable.  An empty table, or one without words, gives targets of 0.  Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymarks.llm.stored import stored

#: A word, as a pattern.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a source in one part, about.
PART_ROWS = 50_000
SLOTS_IN_PART = 1 << 16
#: Points of the schedule whose owners are found together.
POINTS_IN_STRETCH = 1 << 16


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _before(rows: DataFrame, group: list[str], part: str, order: list, size: Column) -> DataFrame:
    """Add ``before``: the sum of ``size`` over earlier parts of the group and earlier rows of the
    part.  Only sums of parts share a window of the whole group."""
    sums = rows.groupBy(*group, part).agg(F.sum(size).alias("_sum"))
    over = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, part, F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_base"))
    inner = Window.partitionBy(*group, part).orderBy(*order)
    inner = inner.rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(size).over(inner), F.lit(0))
    return (
        rows.withColumn("_own", own)
        .join(sums, [*group, part])
        .withColumn("before", (F.col("_own") + F.col("_base")).cast("bigint"))
        .drop("_own", "_base")
    )


def targets(
    sizes: DataFrame, weights: tuple[float, ...], share: float, repeat: float
) -> DataFrame:
    """(source_key, source_size, weight, target) of each row (source_key, source_size).

    Water filling: sources in order of cap over weight; the first that its share of what is left
    does not fill sets the level for the rest.  One row a source, so one small window.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy("source_key")
    n = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), n + 1)
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * repeat)
    by_cap = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "source_key")
    everything = Window.partitionBy(F.lit(0))
    full = F.coalesce(
        F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    left = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything) * share
    s = s.withColumn("level", (total - full) / left)
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    first = F.min(F.when(fits, F.struct(F.col("cap") / F.col("weight"), "source_key", "level")))
    s = s.withColumn("level", first.over(everything)["level"])
    target = F.least(F.coalesce(F.col("level") * F.col("weight"), F.col("cap")), F.col("cap"))
    return s.select("source_key", "source_size", "weight", target.alias("target"))


def _source_key(column: Column | str) -> Column:
    """Sources by code point (UTF-8 order), NULL last."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), column))


def van_der_corput(n: Column, bits: int = 40) -> Column:
    """The bits of ``n`` mirrored behind the point, as a double in [0, 1)."""
    return F.conv(F.reverse(F.lpad(F.conv(n, 10, 2), bits, "0")), 2, 10).cast("double") / float(
        1 << bits
    )


def _owners(slots: DataFrame, goal: DataFrame) -> DataFrame:
    """(slot, source_key): the source whose interval [low, high) holds a slot's point.

    Points are dealt to stretches of the line, intervals to each stretch they begin in or enter; in
    order of a stretch, the last interval begun before a point is its owner.
    """
    stretch = F.floor(F.col("point") / POINTS_IN_STRETCH)
    entered = F.sequence(
        F.floor(F.col("low") / POINTS_IN_STRETCH), F.floor((F.col("high") - 1) / POINTS_IN_STRETCH)
    )
    begun = goal.select("source_key", "low", F.explode(entered).alias("stretch")).select(
        "stretch",
        F.greatest("low", F.col("stretch") * POINTS_IN_STRETCH).alias("point"),
        F.lit(-1).cast("bigint").alias("slot"),
        "source_key",
    )
    points = slots.select(
        stretch.alias("stretch"), "point", "slot", F.lit(None).cast("string").alias("source_key")
    )
    line = Window.partitionBy("stretch").orderBy("point", "slot")
    owner = F.last("source_key", ignorenulls=True).over(line)
    owned = begun.unionByName(points).withColumn("source_key", owner)
    return owned.where("slot >= 0").select("slot", "source_key")


class Mix:
    """The stream of pieces of documents, in the order of the mix.

    ``documents``: one row a document with size, source, source_size and target.  ``schedule``: one
    row for each piece of a document in a slot: slot, source, doc, first_word, words.
    """

    def __init__(
        self,
        docs: DataFrame,
        weights: tuple[float, ...] = (5, 2, 1),
        share: float = 1.5,
        repeat: int = 2,
        block_words: int = 4096,
        seed: int = 7,
    ):
        plain = docs.select(F.col("doc_id").cast("bigint"), "source", "text")
        # Repeated rows get row numbers of their own below; the text's hash orders the others.
        rows = stored(
            plain.select(
                "doc_id",
                _source_key("source").alias("source_key"),
                word_count("text").alias("size"),
                F.xxhash64("doc_id", F.lit(seed)).alias("mixed"),
                F.xxhash64("text").alias("print"),
            ),
            "sizes",
        )
        count = rows.count()
        parts = max(1, -(-count // PART_ROWS))
        # The shuffled order: by hash of id, NULL ids by hash of text.
        mixed = F.when(F.col("doc_id").isNull(), F.col("print")).otherwise(F.col("mixed"))
        rows = rows.withColumn("mixed", mixed)
        # Parts are ranges of the hash, so that parts in turn are the whole order.
        part = F.floor((F.col("mixed") / float(1 << 63) + 1.0) / 2.0 * parts).cast("int")
        rows = rows.withColumn("part", F.least(part, F.lit(parts - 1)))
        order = ["mixed", "doc_id", "print", "size"]
        placed = _before(rows, ["source_key"], "part", order, F.col("size"))
        sizes = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"))
        goal = stored(targets(sizes, weights, share, repeat), "targets")
        give = F.round("target").cast("bigint")
        self.documents = stored(
            placed.join(goal.withColumn("give", give), "source_key"), "placed"
        )
        self.block_words = block_words
        self.goal = goal.withColumn("give", give)

    def pieces(self) -> DataFrame:
        """Documents cut at block ends: (source_key, block, doc_id, size, first_word, words)."""
        b = self.block_words
        d = self.documents.where("size > 0").withColumn("lap", F.explode(F.array(F.lit(0), F.lit(1))))
        d = d.withColumn("start", F.col("before") + F.col("lap") * F.col("source_size"))
        d = d.withColumn("end", F.least(F.col("start") + F.col("size"), F.col("give")))
        d = d.where("end > start")
        block = F.sequence(
            F.floor(F.col("start") / b), F.floor((F.col("end") - 1) / b)
        )
        d = d.withColumn("block", F.explode(block))
        low = F.greatest("start", F.col("block") * b)
        high = F.least("end", (F.col("block") + 1) * b)
        return d.select(
            "source_key",
            "block",
            "doc_id",
            "mixed",
            "print",
            "before",
            (low - F.col("start")).alias("first_word"),
            (high - low).alias("words"),
        )

    def slots(self) -> DataFrame:
        """(slot, source_key, block): which block each slot of the mix takes."""
        b = float(self.block_words)
        everything = Window.partitionBy(F.lit(0))
        running = everything.orderBy("source_key").rowsBetween(Window.unboundedPreceding, 0)
        goal = self.goal.where("give > 0").withColumn("need", F.ceil(F.col("give") / b))
        goal = goal.withColumn("high", F.sum("need").over(running))
        goal = goal.withColumn("low", F.col("high") - F.col("need"))
        total = goal.agg(F.sum("need")).first()[0] or 0
        spark = goal.sparkSession
        slots = spark.range(total).withColumnRenamed("id", "slot")
        # A point in [0, total) lies in the interval of one source.
        point = F.floor(van_der_corput(F.col("slot")) * F.lit(float(total))).cast("bigint")
        slots = _owners(slots.withColumn("point", point), goal)
        slots = slots.withColumn("part", F.floor(F.col("slot") / SLOTS_IN_PART))
        ranked = _before(slots, ["source_key"], "part", ["slot"], F.lit(1))
        ranked = ranked.withColumnRenamed("before", "block")
        ranked = ranked.join(goal.select("source_key", "need"), "source_key").where("block < need")
        # What discrepancy left out comes at the end, source by source.  An interval lacks at most
        # about log2(total) of the points, so these lists are short.
        have = ranked.groupBy("source_key").agg((F.max("block") + 1).alias("have"))
        late = goal.join(have, "source_key", "left").withColumn("have", F.coalesce("have", F.lit(0)))
        late = late.where("have < need").select(
            (F.lit(total) + F.col("low") + F.col("have")).alias("first"),
            "source_key",
            F.posexplode(F.sequence("have", F.col("need") - 1)).alias("at", "block"),
        )
        late = late.select((F.col("first") + F.col("at")).alias("slot"), "source_key", "block")
        return ranked.select("slot", "source_key", "block").union(late)

    def schedule(self) -> DataFrame:
        return self.pieces().join(self.slots(), ["source_key", "block"])

    def taken(self) -> DataFrame:
        """Each document with the words that the mix takes of it, repeats counted."""
        key = ["source_key", "before", "mixed", "print"]
        got = self.schedule().groupBy(*key, "doc_id").agg(F.sum("words").alias("taken"))
        same = [F.col(f"d.{c}").eqNullSafe(F.col(f"g.{c}")) for c in (*key, "doc_id")]
        # Documents without words share a position with their successor and take nothing.
        d = self.documents.alias("d").join(got.alias("g"), same, "left")
        taken = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0))
        source = F.when(F.col("d.source_key") != "1", F.expr("substring(d.source_key, 2)"))
        return d.select(
            F.col("d.doc_id").alias("doc_id"),
            source.alias("source"),
            "size",
            "source_size",
            "target",
            taken.cast("bigint").alias("taken"),
        )
