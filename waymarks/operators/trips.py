"""Trips between transport hubs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymarks.functions import geo
from waymarks.operators.dims import one_row_per_cell
from waymarks.operators.ordered import DAILY, Timeline, annotate, merged_runs, neighbours
from waymarks.operators.stays import (
    merge_adjacent_stays,
    relabel_and_remerge,
    stays_from_intervals,
)

# ---- fixed values: hub scenes, mode label and thresholds of the trip rules ----------------
HUB_SCENES = ("YDY2", "YDY3")
RAIL = "高铁"
MIN_TRIP_KM = 20.0
MIN_TRIP_SECONDS = 600
# ---- end of fixed values ------------------------------------------------------------------


def _with_distance(df: DataFrame, a: str, b: str, out: str, meridian: float) -> DataFrame:
    """Add the straight distance in metres between two stay structs."""
    ends = geo.with_metres(df, f"{a}.lon", f"{a}.lat", "_ax", "_ay", meridian)
    ends = geo.with_metres(ends, f"{b}.lon", f"{b}.lat", "_bx", "_by", meridian)
    return ends.withColumn(out, geo.euclid("_ax", "_ay", "_bx", "_by")).drop(
        "_ax", "_ay", "_bx", "_by"
    )


def rail_trip_first_pair(
    stays: DataFrame,
    hubs: DataFrame,
    line: Timeline = DAILY,
    mode: str = RAIL,
    meridian: float = geo.CENTRAL_MERIDIAN,
) -> DataFrame:
    """First hub of a trace and the earliest stay at another hub.

    ``hubs``: cell ``code``, perhaps ``rat``, and hub name ``area_code``.  Of the first stays at each hub, the
    earliest is the origin and the next the arrival; a trace has at most as many as there are
    hubs.
    """
    at_hub = relabel_and_remerge(stays, hubs, line).where(F.col("code") != "")
    keys = list(line.keys)
    visit = F.struct(line.stamp.alias("at"), "code", "s_time", "e_time", "lon", "lat")
    first_visits = at_hub.groupBy(*keys, "code").agg(F.min(visit).alias("_visit"))
    in_order = Window.partitionBy(*keys).orderBy("_visit")
    arrival = (
        first_visits.withColumns(
            {"_nth": F.row_number().over(in_order), "d": F.lead("_visit").over(in_order)}
        )
        .where((F.col("_nth") == 1) & F.col("d").isNotNull())
        .withColumn("o", F.col("_visit"))
    )
    trips = _with_distance(arrival, "o", "d", "mileage", meridian).select(
        *keys,
        F.col("o.e_time").alias("depart_time"),
        F.col("o.code").alias("start_hub"),
        F.col("d.code").alias("end_hub"),
        F.lit(mode).alias("mode"),
        "mileage",
        (F.col("d.s_time") - F.col("o.e_time")).alias("duration"),
    )
    return trips.where(
        (F.col("depart_time") != 0)
        & (F.col("mileage") != 0)
        & (F.col("duration") != 0)
        & (F.col("imsi") != "")
    )


def hub_trip_segments(
    stays: DataFrame,
    hubs: DataFrame,
    line: Timeline = DAILY,
    min_km: float = MIN_TRIP_KM,
    min_seconds: int = MIN_TRIP_SECONDS,
    meridian: float = geo.CENTRAL_MERIDIAN,
) -> DataFrame:
    """Trips as runs of stays in one hub scene: first to last stay of the run, if far or long.

    ``hubs``: ``code``, ``rat`` and ``scene_name`` of the hub cells.
    """
    scenes = one_row_per_cell(hubs.select("code", "rat", F.col("scene_name").alias("hub")))
    at_hub = stays.join(scenes, ["code", "rat"])
    merged = merge_adjacent_stays(at_hub, line, smooth=True, meridian=meridian)
    stay = F.struct("code", "s_time", "e_time", "lon", "lat")
    trips = merged_runs(
        merged,
        line,
        F.col("hub"),
        {
            "_hub": F.first("hub"),
            "a": F.min_by(stay, line.stamp),
            "b": F.max(F.struct(line.stamp.alias("at"), stay.alias("stay"))),
        },
        {"_hub": F.first("_hub"), "a": F.min_by("a", "_at"), "b": F.max("b")},
    ).withColumn("b", F.col("b.stay"))
    trips = _with_distance(trips, "a", "b", "_metres", meridian)
    seconds = F.floor((F.col("b.s_time") - F.col("a.e_time")) / F.lit(1000))
    return (
        trips.withColumns({"mileage": F.col("_metres") / 1000, "_seconds": seconds})
        .where((F.col("mileage") > min_km) | (F.col("_seconds") > min_seconds))
        .select(
            *line.keys,
            F.col("a.code").alias("start_transportation"),
            F.col("b.code").alias("end_transportation"),
            F.substring("_hub", 1, 2).alias("trans_type"),
            F.round("mileage", 6).alias("mileage"),
            F.round(F.col("_seconds") / 3600, 2).alias("duration"),
        )
    )


def hub_trip_changes(
    stays: DataFrame,
    hubs: DataFrame,
    line: Timeline = DAILY,
    compat: bool = False,
    meridian: float = geo.CENTRAL_MERIDIAN,
) -> DataFrame:
    """A row at each change of hub scene, with the previous stay as the hub left.

    Stays outside hubs have an empty scene and take part.  ``compat``: the first scene also
    gives a row, duration is previous end minus start, and at the first, second and last row of
    a trace hub, distance and duration are those of the last regular change.
    """
    scenes = one_row_per_cell(hubs.select("code", "rat", F.col("scene_name").alias("_hub")))
    labelled = stays.join(scenes, ["code", "rat"], "left").withColumn(
        "hub", F.coalesce("_hub", F.lit(""))
    )
    merged = stays_from_intervals(labelled.drop("_hub"), line)
    stay = F.struct("code", "hub", "s_time", "e_time", "lon", "lat")
    rows = merged.withColumn("a", stay)
    if compat:
        rows = annotate(rows, line, before={"b": F.col("a")}, position="_pos", size="_size")
    else:
        rows = neighbours(rows, line, before={"b": F.col("a")})
    rows = _with_distance(rows, "a", "b", "_metres", meridian)
    left = F.coalesce(F.col("b.hub"), F.lit(""))
    gap = F.col("a.s_time") - F.col("b.e_time")
    values = F.struct(
        F.col("b.code").alias("end_hub"),
        F.col("_metres").alias("mileage"),
        (-gap if compat else gap).alias("duration"),
    )
    turn = F.col("a.hub") != left
    if compat:
        regular = turn & (F.col("_pos") > 2) & (F.col("_pos") < F.col("_size"))
        rows = rows.withColumn("_value", F.when(regular, values))
        rows = annotate(rows, line, last_upto={"_kept": F.col("_value")}).where(turn)
    else:
        rows = rows.where(turn & F.col("b").isNotNull()).withColumn("_kept", values)
    return rows.select(
        *line.keys,
        F.col("s_time").alias("depart_time"),
        F.col("a.code").alias("start_hub"),
        F.coalesce("_kept.end_hub", F.lit("")).alias("end_hub"),
        F.col("a.hub").alias("mode"),
        F.coalesce("_kept.mileage", F.lit(0.0)).alias("mileage"),
        F.coalesce("_kept.duration", F.lit(0)).cast("bigint").alias("duration"),
    )


def published_trips(trips: DataFrame, subscribers: DataFrame) -> DataFrame:
    """Hub trips with the day as ``timeStamp`` and phone and imei of the subscriber, blank where unknown."""
    known = subscribers.groupBy("imsi").agg(F.min(F.struct("phone", "imei")).alias("_user"))
    blank = F.lit("")
    return trips.join(known, "imsi", "left").select(
        F.col("date").alias("timeStamp"),
        "imsi",
        F.coalesce("_user.phone", blank).alias("phone"),
        F.coalesce("_user.imei", blank).alias("imei"),
        *[c for c in trips.columns if c not in ("imsi", "date")],
    )
