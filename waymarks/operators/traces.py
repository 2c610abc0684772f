"""Questions about a subscriber's trace: visits, dwell, passages, commutes and the day's trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymarks.functions import geo
from waymarks.functions.calendar import HOUR_MS, MINUTE_MS, SHANGHAI, Clock
from waymarks.operators.intervals import spread_join
from waymarks.operators.ordered import DAILY, Timeline, annotate, exact_median, neighbours

WORK_START_HOUR = 8
WORK_END_HOUR = 17
STAY_FIELDS = ("event_id", "code", "s_time", "e_time", "lon", "lat")


def trace_contains(stays: DataFrame, code: str, keys=("imsi", "date")) -> DataFrame:
    hit = F.coalesce(F.col("code") == code, F.lit(False))
    return stays.groupBy(*keys).agg(F.max(hit).alias("visited"))


def _at_places(stays: DataFrame, places: DataFrame, keys, name: str, value: Column) -> DataFrame:
    """``value``, a sum or count, of the stays at the coordinates of each place, per trace and place.

    Stays are summed per coordinate before they meet places, so only a place with several coordinates
    needs a sum of pairs.
    """
    stays, places = (df.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()) for df in (stays, places))
    visits = stays.groupBy(*keys, "lon", "lat").agg(value.alias(name))
    spots = places.groupBy("place", "lon", "lat").agg(F.count(F.lit(1)).alias("_times"))
    spots = spots.withColumn("_spots", F.count(F.lit(1)).over(Window.partitionBy("place")))

    def met(some: DataFrame) -> DataFrame:
        pairs = spread_join(visits, some.drop("_spots"), ("lon", "lat"), left_counted=stays)
        return pairs.select(*keys, "place", (F.col(name) * F.col("_times")).alias(name))

    several = met(spots.where(F.col("_spots") > 1)).groupBy(*keys, "place").agg(F.sum(name).alias(name))
    return met(spots.where(F.col("_spots") == 1)).unionByName(several)


def trace_passby_count(stays: DataFrame, places: DataFrame, keys=("imsi", "date")) -> DataFrame:
    """Stays whose coordinates equal a place's, per trace and place (``place``, lon, lat)."""
    return _at_places(stays, places, keys, "passes", F.count(F.lit(1)))


def total_time_by_code(stays: DataFrame, keys=("imsi", "date")) -> DataFrame:
    return stays.groupBy(*keys, "code").agg(F.sum("duration").alias("total_ms"))


def total_time_by_coord(stays: DataFrame, places: DataFrame, keys=("imsi", "date")) -> DataFrame:
    """Time of the stays whose coordinates equal a place's, per trace and place."""
    return _at_places(stays, places, keys, "total_ms", F.sum("duration"))


def sub_trace_by_time(
    stays: DataFrame, start: Column, end: Column, overlap: bool = False
) -> DataFrame:
    """Stays inside [start, end]; with ``overlap`` also those that only touch it."""
    if overlap:
        return stays.where((F.col("s_time") <= end) & (F.col("e_time") >= start))
    return stays.where((F.col("s_time") >= start) & (F.col("e_time") <= end))


def stays_at_code(stays: DataFrame, code: str) -> DataFrame:
    return stays.where(F.col("code") == code)


def passages(
    stays: DataFrame, origin: Column, destination: Column, line: Timeline = DAILY
) -> DataFrame:
    """Every passage from an origin to a destination place within a trace.

    A passage runs from the latest origin stay to the first destination stay after it.  Only
    stays at the two places matter for finding it, so the others are dropped before the
    shuffle.  Result: the trace keys and the stays ``o`` and ``d``.
    """
    fields = F.struct(*STAY_FIELDS)
    ends = stays.where((F.col("code") == origin) | (F.col("code") == destination)).withColumns(
        {"_is_o": F.col("code") == origin, "_here": fields}
    )
    rows = neighbours(ends, line, before={"_was_o": F.col("_is_o"), "o": F.col("_here")})
    found = rows.where(~F.col("_is_o") & F.col("_was_o"))
    return found.withColumn("d", F.col("_here")).drop("_is_o", "_was_o", "_here")


def sub_traces_between(
    stays: DataFrame, origin: Column, destination: Column, line: Timeline = DAILY
) -> DataFrame:
    """All stays of every passage, with ``passage``: the stamp of its origin stay."""
    is_o = F.col("code") == origin
    is_d = ~is_o & (F.col("code") == destination)
    mark = F.when(is_o | is_d, F.struct(line.stamp.alias("at"), is_o.alias("open")))
    rows = annotate(stays, line, last_before={"_mark": mark})
    open_ = F.col("_mark.open")
    rows = rows.withColumn(
        "passage", F.when(is_o, line.stamp).when(open_, F.col("_mark.at"))
    ).where(F.col("passage").isNotNull())
    complete = rows.where(is_d).select(*line.keys, "passage")
    return line.unsliced(rows.join(complete, [*line.keys, "passage"], "left_semi")).drop("_mark")


def path_length(stays: DataFrame, line: Timeline = DAILY, meridian=geo.CENTRAL_MERIDIAN):
    """Sum of leg lengths of a trace, straight and along the axes; 0 for a single stay."""
    located = geo.with_metres(
        stays.select(*line.keys, *line.order, "lon", "lat"), x="_x", y="_y", meridian=meridian
    )
    rows = neighbours(
        located.drop("lon", "lat"),
        line,
        before={"_px": F.col("_x"), "_py": F.col("_y")},
    )
    zero = F.lit(0.0)
    return rows.groupBy(*line.keys).agg(
        F.coalesce(F.sum(geo.euclid("_x", "_y", "_px", "_py")), zero).alias("distance"),
        F.coalesce(F.sum(geo.manhattan("_x", "_y", "_px", "_py")), zero).alias(
            "manhattan_distance"
        ),
    )


def path_length_in_window(stays: DataFrame, start: Column, end: Column, line: Timeline = DAILY):
    return path_length(sub_trace_by_time(stays, start, end), line)


def trace_cost_time(stays: DataFrame, line: Timeline = DAILY) -> DataFrame:
    """Start of the last stay minus end of the first."""
    return stays.groupBy(*line.keys).agg(
        (F.max_by("s_time", line.stamp) - F.min_by("e_time", line.stamp)).alias("cost_ms")
    )


def od_mean_cost_time(
    stays: DataFrame, origin: str, destination: str, line: Timeline = DAILY
) -> DataFrame:
    """Mean time of a trace's passages; traces without a positive total have no row."""
    legs = passages(stays, F.lit(origin), F.lit(destination), line)
    total = F.sum(F.col("d.s_time") - F.col("o.e_time"))
    return (
        legs.groupBy(*line.keys)
        .agg(total.alias("_total"), F.count(F.lit(1)).alias("passages"))
        .where(F.col("_total") > 0)
        .select(*line.keys, "passages", F.floor(F.col("_total") / F.col("passages")).alias("mean_ms"))
    )


def _with_home_work(stays: DataFrame, subscribers: DataFrame, kind: str) -> DataFrame:
    field = kind.lower() if kind != "SECTOR" else "sector"
    places = subscribers.select(
        "imsi", F.col(f"live.{field}").alias("home"), F.col(f"work.{field}").alias("office")
    )
    return stays.join(places, "imsi")


def home_work_passages(
    stays: DataFrame, subscribers: DataFrame, kind: str = "AOI", line: Timeline = DAILY
) -> DataFrame:
    """Passages between each subscriber's home and work place, in both directions.

    Home and work stays alternate between the two directions, so one look back finds both.
    """
    both = _with_home_work(stays, subscribers, kind)
    ends = both.where(
        (F.col("home") != F.col("office"))
        & ((F.col("code") == F.col("home")) | (F.col("code") == F.col("office")))
    ).withColumn("_here", F.struct(*STAY_FIELDS))
    rows = neighbours(ends, line, before={"o": F.col("_here")})
    found = rows.where(F.col("o.code") != F.col("code"))
    return found.select(
        *line.keys,
        F.when(F.col("o.code") == F.col("home"), "home_to_work")
        .otherwise("work_to_home")
        .alias("direction"),
        "o",
        F.col("_here").alias("d"),
    )


def commute_times(stays, subscribers, kind: str = "AOI", line: Timeline = DAILY) -> DataFrame:
    legs = home_work_passages(stays, subscribers, kind, line)
    return legs.select(
        *line.keys,
        "direction",
        F.col("o.event_id").alias("event_id"),
        (F.col("d.s_time") - F.col("o.e_time")).alias("commute_ms"),
    )


def commute_median(stays, subscribers, kind: str = "AOI", line: Timeline = DAILY) -> DataFrame:
    """Median commute per subscriber and direction."""
    times = commute_times(stays, subscribers, kind, line)
    return exact_median(times, ["imsi", "direction"], "commute_ms", "median_ms")


def _longest_elsewhere(
    stays: DataFrame, line: Timeline, min_minutes: int, same: tuple[str, ...] = ()
) -> DataFrame:
    """Per trace, the code other than ``home`` with the most dwell, as the struct ``_d``.

    Columns named in ``same`` have one value per trace and are kept.
    """
    kept = [F.any_value(c).alias(c) for c in same]
    away = stays.where(F.col("code") != F.col("home"))
    dwell = away.groupBy(*line.keys, "code").agg(
        F.sum("duration").alias("_total"),
        F.min_by(F.struct(*STAY_FIELDS), line.stamp).alias("_stay"),
        *kept,
    )
    best = dwell.groupBy(*line.keys).agg(
        F.min(F.struct((-F.col("_total")).alias("m"), "code", "_stay")).alias("_best"),
        *kept,
    )
    return best.where(-F.col("_best.m") > min_minutes * MINUTE_MS).select(
        *line.keys, (-F.col("_best.m")).alias("total_ms"), F.col("_best._stay").alias("_d"), *same
    )


def max_dwell_destination(
    stays: DataFrame,
    subscribers: DataFrame,
    min_minutes: int = 60,
    kind: str = "AOI",
    line: Timeline = DAILY,
) -> DataFrame:
    """Non-home place with the greatest total dwell, if long enough, and the first stay there."""
    best = _longest_elsewhere(_with_home_work(stays, subscribers, kind), line, min_minutes)
    return best.select(
        *line.keys,
        F.col("_d.code").alias("code"),
        "total_ms",
        F.col("_d.s_time").alias("s_time"),
        F.col("_d.e_time").alias("e_time"),
    )


def one_day_od(
    stays: DataFrame,
    subscribers: DataFrame,
    min_minutes: int = 60,
    kind: str = "AOI",
    line: Timeline = DAILY,
    clock: Clock = SHANGHAI,
    work_start: int = WORK_START_HOUR,
    work_end: int = WORK_END_HOUR,
    meridian: float = geo.CENTRAL_MERIDIAN,
) -> DataFrame:
    """The day's trip: first home stay to the place of longest dwell in working hours.

    Only stays between the end of the first home stay (or the start of work, if earlier) and
    the end of work count.  Traces without a home stay give no row.
    """
    homed = _with_home_work(stays, subscribers, kind)
    at_home = F.when(
        F.col("code") == F.col("home"),
        F.struct(line.stamp.alias("at"), F.struct(*STAY_FIELDS).alias("stay")),
    )
    known = annotate(homed, line, least={"_first": at_home}).where(F.col("_first").isNotNull())
    midnight = clock.day_ms(F.col("date"))
    within = sub_trace_by_time(
        line.unsliced(known).withColumn("_o", F.col("_first.stay")),
        F.least(F.col("_o.e_time"), midnight + work_start * HOUR_MS),
        midnight + work_end * HOUR_MS,
    )
    pairs = _longest_elsewhere(within, line, min_minutes, same=("_o",))
    pairs = geo.with_metres(pairs, "_o.lon", "_o.lat", "_ox", "_oy", meridian)
    pairs = geo.with_metres(pairs, "_d.lon", "_d.lat", "_dx", "_dy", meridian)
    return pairs.select(
        *line.keys,
        F.col("_o.code").alias("o_code"),
        F.col("_d.code").alias("d_code"),
        (F.col("_d.s_time") - F.col("_o.e_time")).alias("time_ms"),
        geo.euclid("_ox", "_oy", "_dx", "_dy").alias("distance"),
        geo.manhattan("_ox", "_oy", "_dx", "_dy").alias("manhattan_distance"),
    )


def order_traces_by_day(stays: DataFrame) -> DataFrame:
    """Traces of each subscriber, newest day first."""
    traces = stays.groupBy("imsi", "date").agg(F.count(F.lit(1)).alias("stays"))
    return traces.orderBy("imsi", F.desc("date"))
