"""Hourly area flows and flows between areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymarks.functions.calendar import HOUR_MS, SHANGHAI, Clock
from waymarks.operators.dims import cell_keys
from waymarks.operators.intervals import LONGEST_MS, broken_intervals, whole_intervals
from waymarks.operators.ordered import DAILY, Timeline, neighbours
from waymarks.operators.stays import relabel_and_remerge


def flow_rejects(stays: DataFrame, longest_ms: int = LONGEST_MS) -> DataFrame:
    """Stays that no hourly flow counts, with the ``reason``."""
    return broken_intervals(stays, "s_time", "e_time", longest_ms)


def _entries(hours: dict[str, Column]) -> Column:
    """One event: what it adds to the numbers of its hour, and to the level from then on."""
    return F.struct(*[hours.get(n, F.lit(0)).cast("bigint").alias(n) for n in ("hour_ms", "came", "left", "turn")])


def _events(stays: DataFrame) -> DataFrame:
    """Arrivals, departures and changes of the level between them, stay by stay."""
    first, last = F.col("_first"), F.col("_last")
    long = last - first > HOUR_MS
    events = F.array(
        _entries({"hour_ms": first, "came": F.lit(1)}),
        _entries({"hour_ms": last, "left": F.lit(1), "turn": F.when(long, -1).otherwise(0)}),
    )
    rise = F.array(_entries({"hour_ms": first + HOUR_MS, "turn": F.lit(1)}))
    return stays.select("code", F.inline(F.when(long, F.concat(events, rise)).otherwise(events)))


def _distinct_events(stays: DataFrame) -> DataFrame:
    """As ``_events``, each user once for an area, hour and role.

    One row for each user, area and hour has the roles as bits, and how long the longest stay that
    began then lasts.  Of that, what earlier stays of the user there already cover is left out.
    """
    first, last = F.col("_first"), F.col("_last")
    nothing = F.lit(None).cast("bigint")
    ends = F.array(
        F.struct(first.alias("hour_ms"), F.lit(1).alias("bits"), last.alias("until")),
        F.struct(last.alias("hour_ms"), F.lit(2).alias("bits"), nothing.alias("until")),
    )
    marks = (
        stays.select("imsi", "code", F.inline(ends))
        .groupBy("imsi", "code", "hour_ms")
        .agg(F.bit_or("bits").alias("bits"), F.max("until").alias("until"))
    )
    past = (
        Window.partitionBy("imsi", "code")
        .orderBy("hour_ms")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    known = marks.withColumn("_covered", F.max("until").over(past))
    start = F.greatest(F.col("hour_ms") + HOUR_MS, F.col("_covered"))
    here = _entries(
        {
            "hour_ms": F.col("hour_ms"),
            "came": F.col("bits").bitwiseAND(1),
            "left": F.shiftright(F.col("bits"), 1),
        }
    )
    level = F.array(
        _entries({"hour_ms": start, "turn": F.lit(1)}),
        _entries({"hour_ms": F.col("until"), "turn": F.lit(-1)}),
    )
    more = start < F.col("until")
    events = F.when(more, F.concat(F.array(here), level)).otherwise(F.array(here))
    # A user without a name is nobody: they are not counted.
    return known.where(F.col("imsi").isNotNull()).select("code", F.inline(events))


def hourly_flow_of_areas(
    area_stays: DataFrame, clock: Clock = SHANGHAI, distinct: bool = False
) -> DataFrame:
    """Stay, inflow, outflow and their total per hour and area of merged area stays.

    Arrivals, departures and rises and falls of the level are summed by area and hour; the running
    sum of an area's rises and falls says who stayed, and fills the hours in which nothing happens.  So a
    stay is two or three events, however long it is.  Stays of ``flow_rejects`` do not count.
    """
    whole = whole_intervals(area_stays, "s_time", "e_time")
    first, last = clock.hour_start(F.col("s_time")), clock.hour_start(F.col("e_time"))
    stays = whole.select("imsi", "code", first.alias("_first"), last.alias("_last"))
    events = _distinct_events(stays) if distinct else _events(stays)
    sums = events.groupBy("code", "hour_ms").agg(
        *[F.sum(c).alias(c) for c in ("came", "left", "turn")]
    )
    hours = Window.partitionBy("code").orderBy("hour_ms")
    level = F.sum("turn").over(hours.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    known = sums.withColumns({"stay_count": level, "_next": F.lead("hour_ms").over(hours)})
    gap = (F.col("stay_count") > 0) & (F.col("_next") > F.col("hour_ms") + HOUR_MS)
    quiet = F.sequence(F.col("hour_ms") + HOUR_MS, F.col("_next") - HOUR_MS, F.lit(HOUR_MS))

    def row(hour: Column, came: Column, left: Column) -> Column:
        return F.struct(hour.alias("hour_ms"), came.alias("in_count"), left.alias("out_count"))

    nobody = F.lit(0).cast("bigint")
    own = F.array(row(F.col("hour_ms"), F.col("came"), F.col("left")))
    filled = F.concat(own, F.transform(quiet, lambda h: row(h, nobody, nobody)))
    counted = known.select("code", "stay_count", F.inline(F.when(gap, filled).otherwise(own)))
    counted = counted.where(
        (F.col("stay_count") != 0) | (F.col("in_count") != 0) | (F.col("out_count") != 0)
    )
    return counted.select(
        clock.hour_label(F.col("hour_ms")).alias("hour_stamp"),
        "code",
        (F.col("stay_count") + F.col("in_count") - F.col("out_count")).alias("total"),
        "stay_count",
        "in_count",
        "out_count",
    )


def hourly_area_flow(
    stays: DataFrame,
    cells: DataFrame,
    line: Timeline = DAILY,
    clock: Clock = SHANGHAI,
    distinct: bool = False,
) -> DataFrame:
    """Hourly flow of every county, with its name and city.

    ``cells``: ``code``, ``county_id``, ``county_name``, ``city_id`` and, where codes of 2G and 4G cells
    can be equal, ``rat``.  The names are joined to the counted rows, not to the stays.
    """
    area = cells.select(*cell_keys(stays, cells), F.col("county_id").alias("area_code"))
    merged = relabel_and_remerge(stays, area, line, smooth=True, midpoint=False)
    names = cells.groupBy(F.col("county_id").alias("code")).agg(
        F.min("county_name").alias("name"), F.min("city_id").alias("city_id")
    )
    return hourly_flow_of_areas(merged, clock, distinct).join(names, "code", "left")


def hourly_custom_area_flow(
    stays: DataFrame,
    area: DataFrame,
    line: Timeline = DAILY,
    clock: Clock = SHANGHAI,
) -> DataFrame:
    """Hourly flow of a given list of cells and areas; only hours with all numbers above 0."""
    merged = relabel_and_remerge(stays, area, line, smooth=True, midpoint=False)
    flow = hourly_flow_of_areas(merged.where(F.col("code") != ""), clock)
    return flow.where(
        (F.col("total") > 0)
        & (F.col("stay_count") > 0)
        & (F.col("in_count") > 0)
        & (F.col("out_count") > 0)
    )


def area_transition_flow(
    stays: DataFrame,
    cells: DataFrame,
    line: Timeline = DAILY,
    clock: Clock = SHANGHAI,
) -> DataFrame:
    """Distinct users per pair of areas, direction and hour.

    Every change of area gives an "out" row of the area left, at the hour it is left, and an
    "in" row of the area entered, at the hour it is entered.
    """
    area_code = F.concat_ws("_", "city_id", "county_id").alias("area_code")
    area = cells.select(*cell_keys(stays, cells), area_code)
    merged = relabel_and_remerge(stays, area, line, smooth=True, midpoint=False)
    moves = neighbours(
        merged,
        line,
        before={"_from": F.col("code"), "_left": F.col("e_time")},
    ).where(F.col("_from").isNotNull())

    def part(code: str, i: int) -> Column:
        return F.coalesce(F.try_element_at(F.split(code, "_"), F.lit(i)), F.lit(""))

    def row(a: str, b: str, direction: str, at: str) -> Column:
        return F.struct(
            part(a, 1).alias("city1"),
            part(a, 2).alias("district1"),
            part(b, 1).alias("city2"),
            part(b, 2).alias("district2"),
            F.lit(direction).alias("direction"),
            clock.hour_range(F.col(at)).alias("time_second"),
        )

    rows = moves.select(
        F.col("date").alias("date_day"),
        "imsi",
        F.inline(F.array(row("_from", "code", "out", "_left"), row("code", "_from", "in", "s_time"))),
    )
    return rows.groupBy(
        "date_day", "city1", "district1", "city2", "district2", "direction", "time_second"
    ).agg(F.count_distinct("imsi").alias("user_num"))
