"""Looking along a subscriber's ordered rows, however many one subscriber has.

A trace (the rows of ``Timeline.keys``) is cut into time slices of ``slice_ms``, and rows are dealt by
trace and slice, so a trace with millions of rows in an hour is many tasks.  Windows run inside a
slice.  There is one way for every size and no counting pass.  What lies beyond a slice comes in one of
three ways, each with one scan and one shuffle of the rows by slice:

- ``neighbours``: only the first and last row of a slice lack a neighbour.  These edge rows, two a
  slice, meet in a window of their trace; rows inside stay with their slice.
- ``merged_runs``: runs inside a slice are final.  The first and last run of each slice, already
  aggregated, meet their neighbours in the same way and merge.
- ``annotate``: values that any row may need (last known value, run, position, whole-trace flags) come
  from one summary row per slice, made from the same dealt rows and joined back.

Rows with equal order columns are ordered by the value that makes runs, else by ``code``; ``annotate``
then takes a hash of the whole row.  The hash is made from the dealt rows: rows and summaries need
the same columns there, so both read one shuffle of one scan.

The trace is one struct column, which is never NULL itself, so rows and summaries meet in a plain
equality join also where a key is NULL.  A hash of it stands before it, so that sorts compare numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Length of a slice: a trace of a million rows an hour has a few thousand in each.
SLICE_MS = 10_000


@dataclass(frozen=True)
class Timeline:
    """Which rows form a trace, how they are ordered, and how long a slice is."""

    keys: tuple[str, ...] = ("imsi", "date")
    order: tuple[str, ...] = ("s_time", "event_id")
    slice_ms: int = SLICE_MS

    def ordered_by(self, *order: str) -> Timeline:
        return replace(self, order=order)

    @property
    def trace(self) -> str:
        return "_trace_" + "_".join(self.keys)

    @property
    def slice(self) -> str:
        return f"_slice_{self.order[0]}_{self.slice_ms}"

    @property
    def row(self) -> str:
        return "_row_hash"

    @property
    def whole(self) -> list[str]:
        """Columns that name a trace."""
        return [f"{self.trace}_hash", self.trace]

    @property
    def here(self) -> list[str]:
        """Columns by which rows are dealt."""
        return [f"{self.trace}_hash", self.slice, self.trace]

    @property
    def stamp(self) -> Column:
        return F.struct(*self.order)

    def sliced(self, df: DataFrame) -> DataFrame:
        """Rows with the columns by which they are dealt."""
        if set(self.here) <= set(df.columns):
            return df
        return df.withColumns(
            {
                f"{self.trace}_hash": F.xxhash64(*self.keys),
                self.trace: F.struct(*self.keys),
                self.slice: F.floor(F.col(self.order[0]) / F.lit(self.slice_ms)),
            }
        )

    def dealt(self, df: DataFrame) -> DataFrame:
        """Rows dealt by trace and slice, with a hash; those that are already stay where they are."""
        if self.row in df.columns and set(self.here) <= set(df.columns):
            return df
        hashed = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        rows = self.sliced(df).repartition(*self.here)
        return rows.withColumn(self.row, F.xxhash64(*hashed))

    def unsliced(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.here, self.row)


DAILY = Timeline()
LIFETIME = Timeline(keys=("imsi",))


def _packed(columns: dict[str, Column]) -> Column:
    return F.struct(*_named(columns))


def _tie(df: DataFrame, run_of: Column | None = None) -> Column:
    return run_of if run_of is not None else F.col("code") if "code" in df.columns else F.lit(0)


def neighbours(
    df: DataFrame,
    line: Timeline = DAILY,
    *,
    before: dict[str, Column] | None = None,
    after: dict[str, Column] | None = None,
) -> DataFrame:
    """Add values of the row just before and just after in the trace, NULL at its ends."""
    before, after = before or {}, after or {}
    rows = line.sliced(df)
    local = Window.partitionBy(*line.here).orderBy(*line.order, _tie(df))
    # NULL at the first, at the last row of a slice.
    rows = rows.withColumns(
        {
            "_before": F.lag(_packed({"_": F.lit(1), **before})).over(local),
            "_after": F.lead(_packed({"_": F.lit(1), **after})).over(local),
        }
    )
    first, last = F.col("_before").isNull(), F.col("_after").isNull()
    rows = rows.withColumns({"_inside": F.when(~first & ~last, F.col(line.slice)), "_first": first})
    edges = Window.partitionBy(line.whole[0], "_inside", line.whole[1]).orderBy(
        line.slice, F.desc("_first")
    )
    result: dict[str, Column] = {}
    if before:
        result["_edge_before"] = F.lag(_packed(before)).over(edges)
    if after:
        result["_edge_after"] = F.lead(_packed(after)).over(edges)
    rows = rows.withColumns(result)
    found = {n: F.when(first, F.col("_edge_before")[n]).otherwise(F.col("_before")[n]) for n in before}
    found |= {n: F.when(last, F.col("_edge_after")[n]).otherwise(F.col("_after")[n]) for n in after}
    rows = rows.withColumns(found)
    return line.unsliced(rows).drop("_before", "_after", "_inside", "_first", *result)


def merged_runs(
    df: DataFrame,
    line: Timeline,
    run_of: Column,
    parts: dict[str, Column],
    merge: dict[str, Column],
    *,
    by: str | None = None,
    smooth: bool = False,
    from_end: Column | None = None,
) -> DataFrame:
    """One row for each run of rows with equal ``run_of`` along a trace.

    ``parts`` aggregates the rows of a run inside a slice; ``merge`` brings columns of the same names
    together over the slices of a run, where ``_at`` is the stamp of a part's first row.  With ``by``, a part
    is aggregated by that column first.  ``smooth`` adds ``e_time``: the latest end, each cut at the
    next row's start.  ``from_end`` counts its values from a row to the end of its part (``_from_end``).
    Result: the keys, ``at`` (stamp of the first row) and the columns of ``merge``.
    """
    here, stamp = line.here, F.struct(*line.order)
    rows = line.sliced(df)
    local = Window.partitionBy(*here).orderBy(*line.order, _tie(df, run_of))
    rows = rows.withColumns(
        {
            "_row": F.row_number().over(local),
            "_next": F.lead(F.struct((F.col("s_time") if smooth else F.lit(1)).alias("v"))).over(local),
            "_was": F.lag(F.struct(run_of.alias("v"))).over(local),
        }
    )
    turn = (F.col("_row") > 1) & ~F.col("_was.v").eqNullSafe(run_of)
    rows = rows.withColumn("_run", F.sum(turn.cast("int")).over(local))
    if from_end is not None:
        back = Window.partitionBy(*here, "_run").orderBy(*[F.desc(c) for c in line.order])
        to_end = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumn("_from_end", F.count(from_end).over(to_end))
    last = F.col("_next").isNull()
    edges = {"_at": F.min(stamp), "_value": F.first(run_of), "_opens": F.min("_row"), "_closes": F.max(last)}
    again = {"_at": F.min("_at"), "_value": F.first("_value"), "_opens": F.min("_opens"), "_closes": F.max("_closes")}
    if smooth:
        # The last row of a slice is cut at the first row of the next one.
        parts = {
            **parts,
            "e_time": F.max(F.when(~last, F.least("e_time", F.col("_next.v")))),
            "_last_end": F.max(F.when(last, F.col("e_time"))),
            "_start": F.min("s_time"),
        }
        merge = {**merge, "e_time": F.max("e_time")}
    group = [*here, "_run"]
    first_group = group if by is None else [*group, by]
    found = rows.groupBy(*first_group).agg(*_named({**parts, **edges}))
    if by is not None:
        found = found.groupBy(*group).agg(*_named({**merge, **again}))
    inside = (F.col("_opens") > 1) & ~F.col("_closes")
    found = found.withColumn("_inside", F.when(inside, F.col(line.slice)))
    edge = [line.whole[0], "_inside", line.whole[1]]
    across = Window.partitionBy(*edge).orderBy(line.slice, "_run")
    came = F.lag(F.struct(F.col(line.slice).alias("slice"), F.col("_value").alias("v"))).over(across)
    found = found.withColumns(
        {"_came": came, **({"_then": F.lead("_start").over(across)} if smooth else {})}
    )
    goes_on = (F.col("_came.slice") != F.col(line.slice)) & F.col("_came.v").eqNullSafe(F.col("_value"))
    columns = {"_new": F.coalesce(~goes_on, F.lit(True)).cast("int")}
    if smooth:
        end = F.when(F.col("_closes"), F.least("_last_end", "_then"))
        columns["e_time"] = F.greatest("e_time", end)
    found = found.withColumns(columns).withColumn("_whole", F.sum("_new").over(across))
    merged = found.groupBy(*edge, "_whole").agg(F.min("_at").alias("at"), *_named(merge))
    keys = [F.col(line.trace)[k].alias(k) for k in line.keys]
    return merged.select(*keys, "at", *merge)


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def annotate(
    df: DataFrame,
    line: Timeline = DAILY,
    *,
    before: dict[str, Column] | None = None,
    after: dict[str, Column] | None = None,
    last_before: dict[str, Column] | None = None,
    last_upto: dict[str, Column] | None = None,
    run_of: Column | None = None,
    position: str | None = None,
    size: str | None = None,
    anywhere: dict[str, Column] | None = None,
    least: dict[str, Column] | None = None,
) -> DataFrame:
    """Add columns read from other rows of the same trace.

    ``before``/``after``: values of the row just before/after, NULL at the ends.
    ``last_before``/``last_upto``: last non-NULL value before this row / up to this row.
    ``run_of``: adds ``run``, the order stamp and value of the first row of the current run of
    equal values.  ``position``/``size``: 1-based row number in the trace, and its length.
    ``anywhere``: whether a condition holds for any row of the trace.  ``least``: the smallest
    non-NULL value in the trace.
    The columns of ``Timeline.here`` stay on the result so that a following call needs no shuffle.
    """
    before, after = before or {}, after or {}
    last_before, last_upto = last_before or {}, last_upto or {}
    here = line.here
    rows = line.dealt(df)
    tie = _tie(df, run_of)
    stamp = F.struct(*line.order, tie.alias("_tie"), line.row)
    local = Window.partitionBy(*here).orderBy(*line.order, tie, line.row)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    past = local.rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*line.whole).orderBy(line.slice)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)

    # Always true; a summary that names the row's hash needs the same columns as the rows.
    whole_row = F.col(line.row) <= F.lit(2**63 - 1)

    # For each request: the value inside the slice, what a slice tells the others, what it
    # takes over from them, and how the two make the result.
    local_columns: dict[str, Column] = {}
    summary: list[Column] = []
    carried: dict[str, Column] = {}
    result: dict[str, Column] = {}

    if before:
        local_columns["_l_before"] = F.lag(_packed(before)).over(local)
        summary.append(F.max_by(_packed(before), stamp).alias("_s_last"))
        carried["_c_before"] = F.lag("_s_last").over(across)
        for name in before:
            result[name] = F.coalesce("_l_before", "_c_before")[name]
    if after:
        local_columns["_l_after"] = F.lead(_packed(after)).over(local)
        summary.append(F.min_by(_packed(after), stamp).alias("_s_first"))
        carried["_c_after"] = F.lead("_s_first").over(across)
        for name in after:
            result[name] = F.coalesce("_l_after", "_c_after")[name]
    for frame, columns in ((past, last_before), (upto, last_upto)):
        for name, value in columns.items():
            local_columns[f"_l_{name}"] = F.last(value, ignorenulls=True).over(frame)
            summary.append(
                F.max_by(value, F.when(value.isNotNull(), stamp)).alias(f"_s_{name}")
            )
            carried[f"_c_{name}"] = F.last(f"_s_{name}", ignorenulls=True).over(earlier)
            result[name] = F.coalesce(f"_l_{name}", f"_c_{name}")
    if position or size:
        summary.append(F.count_if(whole_row).alias("_s_rows"))
    if position:
        local_columns["_l_pos"] = F.row_number().over(local)
        carried["_c_pos"] = F.sum("_s_rows").over(earlier)
        skipped = F.coalesce("_c_pos", F.lit(0))
        result[position] = (F.col("_l_pos") + skipped).cast("long")
    if size:
        carried["_c_size"] = F.sum("_s_rows").over(Window.partitionBy(*line.whole))
        result[size] = F.col("_c_size")
    for name, condition in (anywhere or {}).items():
        summary.append(F.max(condition & whole_row).alias(f"_s_{name}"))
        carried[f"_c_{name}"] = F.max(f"_s_{name}").over(Window.partitionBy(*line.whole))
        result[name] = F.coalesce(f"_c_{name}", F.lit(False))
    for name, value in (least or {}).items():
        summary.append(F.min(F.when(whole_row, value)).alias(f"_s_{name}"))
        carried[f"_c_{name}"] = F.min(f"_s_{name}").over(Window.partitionBy(*line.whole))
        result[name] = F.col(f"_c_{name}")
    if run_of is not None:
        turn = F.when(
            (F.row_number().over(local) > 1) & ~F.lag(run_of).over(local).eqNullSafe(run_of),
            stamp,
        )
        rows = rows.withColumn("_l_turn", turn)
        local_columns["_l_run"] = F.last("_l_turn", ignorenulls=True).over(upto)
        local_columns["_l_open"] = F.first(stamp).over(upto)
        summary += [
            F.min(stamp).alias("_s_open"),
            F.max("_l_turn").alias("_s_turn"),
            F.min_by(F.struct(run_of.alias("v")), stamp).alias("_s_head"),
            F.max_by(F.struct(run_of.alias("v")), stamp).alias("_s_tail"),
        ]
        found = F.coalesce("_l_run", "_c_run", "_l_open")
        result["run"] = F.struct(*[found[c].alias(c) for c in (*line.order, "_tie")])

    slices = rows.groupBy(*here).agg(*summary)
    if run_of is not None:
        came_from = F.lag("_s_tail").over(across)
        slices = slices.withColumn(
            "_c_opens",
            F.when(
                came_from.isNull() | ~came_from["v"].eqNullSafe(F.col("_s_head")["v"]),
                F.col("_s_open"),
            ),
        ).withColumn(
            "_c_carried",
            F.last(F.coalesce("_s_turn", "_c_opens"), ignorenulls=True).over(earlier),
        )
        carried["_c_run"] = F.coalesce("_c_opens", "_c_carried")
    slices = slices.select(*here, *[c.alias(n) for n, c in carried.items()])
    joined = rows.withColumns(local_columns).join(slices, here, "left").withColumns(result)
    return joined.drop(*local_columns, *carried, "_l_turn")


def exact_median(
    df: DataFrame, keys: list[str], value: str, out: str = "median", bin_width: int = 60_000
) -> DataFrame:
    """Exact median of an integer column per key, without gathering a key's values.

    Values are dealt by bins of ``bin_width`` and counted there.  Bin totals, made from the same dealt
    rows, say which one or two bins hold the middle; only those are ranked.  Groups are bounded
    by the number of bins of a key and by ``bin_width`` distinct values in a bin.
    """
    here = [*keys, "_b"]
    values = df.where(F.col(value).isNotNull()).select(
        *keys, F.floor(F.col(value) / F.lit(bin_width)).alias("_b"), F.col(value).alias("_v")
    )
    counts = values.repartition(*here).groupBy(*here, "_v").agg(F.count(F.lit(1)).alias("_c"))
    bins = counts.groupBy(*here).agg(F.sum("_c").alias("_n"), F.min("_v").alias("_lowest"))
    up = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumns(
        {"_upto": F.sum("_n").over(up), "_all": F.sum("_n").over(Window.partitionBy(*keys))}
    )
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    below = F.col("_upto") - F.col("_n")
    holding = bins.where((F.col("_upto") >= low) & (below < high)).select(
        *here, "_all", "_lowest", below.alias("_below")
    )
    inner = Window.partitionBy(*here).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    # The lowest value keeps the columns of both sides the same, so they share the dealt rows.
    ranked = counts.join(holding, here).where(F.col("_v") >= F.col("_lowest"))
    ranked = ranked.withColumn("_r", F.sum("_c").over(inner) + F.col("_below"))
    middle = ranked.where((F.col("_r") >= low) & (F.col("_r") - F.col("_c") < high))
    return middle.groupBy(*keys).agg(
        ((F.min("_v") + F.max("_v")) / 2).alias(out)
    )
