"""From located points and intervals to stays: segmentation, smoothing and merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymarks.functions import geo
from waymarks.functions.calendar import HOUR_MS
from waymarks.operators.dims import cell_keys, one_row_per_cell
from waymarks.operators.ordered import (
    DAILY,
    LIFETIME,
    Timeline,
    annotate,
    merged_runs,
    neighbours,
)

#: Stretch of a trace that one trace text holds.
PART_MS = HOUR_MS
INDOOR = "INDOOR"
ROAD = "ROAD"


def segment_stays(points: DataFrame, line: Timeline = DAILY, code: str = "code") -> DataFrame:
    """Mark every point with ``run``, the stamp of the first point of its stay.

    Points without a place code take no part and do not split a stay.
    """
    return line.unsliced(
        annotate(points.where(F.col(code).isNotNull()), line, run_of=F.col(code))
    )


def _scene_parts(line: Timeline) -> tuple[dict[str, Column], dict[str, Column]]:
    """Parts of a run's scene: INDOOR when any row is, otherwise the last row's scene."""
    parts = {
        "_indoor": F.max(F.col("scene") == INDOOR),
        "_last": F.max(F.struct(line.stamp.alias("at"), "scene")),
    }
    return parts, {"_indoor": F.max("_indoor"), "_last": F.max("_last")}


def _scene() -> Column:
    return F.when(F.col("_indoor"), INDOOR).otherwise(F.col("_last")["scene"])


def _earliest(sources: Column) -> Column:
    """Of (stamp, source) pairs the earliest of each source, in order."""
    ordered = F.array_sort(sources)
    names = F.transform(ordered, lambda s: s["source"])
    return F.filter(ordered, lambda s, i: F.array_position(names, s["source"]) == i + 1)


def stay_aggregate(
    points: DataFrame,
    line: Timeline = DAILY,
    code: str = "code",
    meridian: float = geo.CENTRAL_MERIDIAN,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """One row per stay: first to last event start, centroid, scene, technology, sources.

    ``source`` is ``|`` and the distinct sources in order of first appearance, whatever they are
    called.  Points are summed by slice, stay and source first, so a stay gathers one entry for each
    of its slices and sources.  ``carried`` columns come from the first point.  Points without a place
    code take no part and do not split a stay.
    """
    located = geo.with_metres(
        points.where(F.col(code).isNotNull()), x="_x", y="_y", meridian=meridian
    )
    scene, merged_scene = _scene_parts(line)
    seen = F.struct(F.min(line.stamp).alias("at"), F.first("source").alias("source"))
    no_source = F.filter(F.array(seen), lambda s: s["source"].isNotNull())
    grouped = merged_runs(
        located,
        line,
        F.col(code),
        {
            "code": F.first(code),
            "s_time": F.min("s_time"),
            "e_time": F.max("s_time"),
            "points": F.count(F.lit(1)),
            "_n": F.count("_x"),
            "_sx": F.sum("_x"),
            "_sy": F.sum("_y"),
            "_first": F.min_by(F.struct("rat", *carried), line.stamp),
            "_sources": no_source,
            **scene,
        },
        {
            "code": F.first("code"),
            "s_time": F.min("s_time"),
            "e_time": F.max("e_time"),
            "points": F.sum("points"),
            "_n": F.sum("_n"),
            "_sx": F.sum("_sx"),
            "_sy": F.sum("_sy"),
            "_first": F.min_by("_first", "_at"),
            "_sources": _earliest(F.flatten(F.collect_list("_sources"))),
            **merged_scene,
        },
        by="source",
    )
    names = F.array_join(F.transform("_sources", lambda s: s["source"]), "")
    stays = grouped.select(
        *line.keys,
        "code",
        "s_time",
        "e_time",
        "points",
        (F.col("_sx") / F.col("_n")).alias("_x"),
        (F.col("_sy") / F.col("_n")).alias("_y"),
        _scene().alias("scene"),
        *[F.col("_first")[c].alias(c) for c in ("rat", *carried)],
        F.concat(F.lit("|"), names).alias("source"),
        F.col("at.event_id").alias("event_id"),
        (F.col("e_time") - F.col("s_time")).alias("duration"),
    )
    return geo.with_degrees(stays, "_x", "_y", meridian=meridian).drop("_x", "_y")


def stay_aggregate_given_center(
    points: DataFrame, centers: DataFrame, line: Timeline = DAILY, code: str = "code"
) -> DataFrame:
    """As ``stay_aggregate`` with the centre looked up by place code; no technology or source."""
    scene, merged_scene = _scene_parts(line)
    grouped = merged_runs(
        points.where(F.col(code).isNotNull()),
        line,
        F.col(code),
        {
            "code": F.first(code),
            "s_time": F.min("s_time"),
            "e_time": F.max("s_time"),
            "points": F.count(F.lit(1)),
            **scene,
        },
        {
            "code": F.first("code"),
            "s_time": F.min("s_time"),
            "e_time": F.max("e_time"),
            "points": F.sum("points"),
            **merged_scene,
        },
    )
    stays = grouped.select(
        *line.keys,
        "code",
        "s_time",
        "e_time",
        "points",
        _scene().alias("scene"),
        F.col("at.event_id").alias("event_id"),
        (F.col("e_time") - F.col("s_time")).alias("duration"),
    )
    places = one_row_per_cell(centers.select("code", "lon", "lat"), ("code",))
    return stays.join(places, "code", "left")


def smooth_overlaps(
    stays: DataFrame, line: Timeline = DAILY, drop_single: bool = False
) -> DataFrame:
    """Cut every stay's end at the start of the next stay of the trace.

    ``drop_single`` leaves out traces of one stay, as the older daily rebuild does.
    """
    next_start = {"_next_start": F.col("s_time")}
    if drop_single:
        rows = annotate(stays, line, after=next_start, size="_size")
        rows = line.unsliced(rows.where(F.col("_size") > 1).drop("_size"))
    else:
        rows = neighbours(stays, line, after=next_start)
    return rows.withColumn("e_time", F.least("e_time", "_next_start")).drop("_next_start")


def validate_stay_order(
    stays: DataFrame, line: Timeline = DAILY, strict: bool = False
) -> DataFrame:
    """Stays that start before the previous one ends; ``strict`` raises on the first one."""
    rows = neighbours(stays, line, before={"previous_end": F.col("e_time")})
    bad = F.col("previous_end") > F.col("s_time")
    if strict:
        message = F.concat(
            F.lit("stays overlap: imsi="), F.col("imsi"), F.lit(" start="), F.col("s_time")
        )
        guarded = F.when(bad, F.raise_error(message).cast("bigint")).otherwise(
            F.col("s_time")
        )
        return rows.withColumn("s_time", guarded).drop("previous_end")
    return rows.where(bad)


def suppress_ping_pong(
    points: DataFrame, line: Timeline = DAILY, code: str = "code"
) -> DataFrame:
    """Rewrite the middle of an A, B, A flip-flop to A."""
    rows = neighbours(
        points, line, before={"_was_at": F.col(code)}, after={"_will_be": F.col(code)}
    )
    there = F.when(F.col("_was_at") == F.col("_will_be"), F.col("_was_at"))
    return rows.withColumn(code, there.otherwise(F.col(code))).drop("_was_at", "_will_be")


def _folded_center(parts: Column) -> Column:
    """Running midpoint of a stay from its per-slice partial sums.

    Taking the midpoint with each later position halves everything before it, so a slice of c
    positions contributes ``carried * 2^-c + partial``; the very first position also stands for
    the empty start.
    """
    start = F.struct(F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))

    def step(acc: Column, p: Column) -> Column:
        decay = F.pow(F.lit(2.0), -p["n"])
        return F.struct(
            (F.coalesce(acc["x"], p["x1"]) * decay + p["sx"]).alias("x"),
            (F.coalesce(acc["y"], p["y1"]) * decay + p["sy"]).alias("y"),
        )

    return F.aggregate(F.array_sort(F.filter(parts, lambda p: p["n"] > 0)), start, step)


def merge_adjacent_stays(
    stays: DataFrame,
    line: Timeline = DAILY,
    code: str = "code",
    smooth: bool = False,
    midpoint: bool = True,
    meridian: float = geo.CENTRAL_MERIDIAN,
) -> DataFrame:
    """Merge neighbouring stays with one code.

    Start and end span the run, the position is the running midpoint (later stays weigh more),
    INDOOR is sticky and every other column comes from the first stay.  ``smooth`` also cuts
    overlaps first, in the same pass.  ``midpoint=False`` keeps the first stay's position.
    """
    computed = {"s_time", "e_time", "duration", "scene", "run"}
    if midpoint:
        stays = geo.with_metres(stays, x="_x", y="_y", meridian=meridian)
    hidden = {"_x", "_y", line.row, *line.here}
    rest = [c for c in stays.columns if c not in computed | {*line.keys} | hidden]
    parts = {
        "s_time": F.min("s_time"),
        "e_time": F.max("e_time"),
        "_first": F.min_by(F.struct(*rest), line.stamp),
        "_stays": F.count(F.lit(1)),
    }
    merge = {
        "s_time": F.min("s_time"),
        "e_time": F.max("e_time"),
        "_first": F.min_by("_first", "_at"),
        "_stays": F.sum("_stays"),
    }
    has_scene = "scene" in stays.columns
    if has_scene:
        scene, merged_scene = _scene_parts(line)
        parts, merge = {**parts, **scene}, {**merge, **merged_scene}
    if midpoint:
        weight = F.pow(F.lit(2.0), -F.col("_from_end"))
        located = F.when(F.col("_x").isNotNull(), line.stamp)
        parts["_middle"] = F.struct(
            F.min(line.stamp).alias("at"),
            F.count("_x").alias("n"),
            F.sum(F.col("_x") * weight).alias("sx"),
            F.sum(F.col("_y") * weight).alias("sy"),
            F.min_by("_x", located).alias("x1"),
            F.min_by("_y", located).alias("y1"),
        )
        merge["_middle"] = F.collect_list("_middle")
    merged = merged_runs(
        stays,
        line,
        F.col(code),
        parts,
        merge,
        smooth=smooth,
        from_end=F.col("_x") if midpoint else None,
    )
    columns: dict[str, Column] = {c: F.col("_first")[c] for c in rest}
    columns["duration"] = F.col("e_time") - F.col("s_time")
    if has_scene:
        columns["scene"] = _scene()
    if midpoint:
        merged = merged.withColumn("_mid", _folded_center(F.col("_middle")))
        merged = geo.with_degrees(merged, "_mid.x", "_mid.y", "_lon", "_lat", meridian)
        single = F.col("_stays") == 1
        columns["lon"] = F.when(single, F.col("_first.lon")).otherwise(F.col("_lon"))
        columns["lat"] = F.when(single, F.col("_first.lat")).otherwise(F.col("_lat"))
    names = [*rest, "s_time", "e_time", "duration", *(["scene"] if has_scene else [])]
    return merged.select(
        *line.keys, *[columns[c].alias(c) if c in columns else F.col(c) for c in names]
    )


def stays_from_intervals(
    intervals: DataFrame, line: Timeline = DAILY, code: str = "code"
) -> DataFrame:
    """Intervals as stays, ordered by end then start, neighbours with one code merged."""
    return merge_adjacent_stays(intervals, line.ordered_by("e_time", "s_time", "event_id"), code)


def relabel_and_remerge(
    stays: DataFrame,
    area: DataFrame,
    line: Timeline = DAILY,
    unknown: str | None = "",
    smooth: bool = False,
    midpoint: bool = True,
) -> DataFrame:
    """Replace the place code by the area code and merge again.

    ``area`` has ``code``, ``area_code`` and perhaps ``rat``; of several rows of a cell the smallest
    counts.  Places outside it get ``unknown``, or keep their code when ``unknown`` is None.
    """
    fallback = F.col("code") if unknown is None else F.lit(unknown)
    keys = cell_keys(stays, area)
    areas = one_row_per_cell(area.select(*keys, "area_code"), tuple(keys))
    labelled = (
        stays.join(areas, keys, "left")
        .withColumn("code", F.coalesce("area_code", fallback))
        .drop("area_code")
    )
    return merge_adjacent_stays(labelled, line, smooth=smooth, midpoint=midpoint)


def cells_per_grid(
    points: DataFrame,
    keys: tuple[str, ...] = ("imsi", "date"),
    line: Timeline = DAILY,
    grid: str = "grid",
) -> DataFrame:
    """Distinct cells a subscriber saw in each grid, in order of first sight, joined by ``#``.

    Cells are made distinct before they are gathered, so a group holds no more entries than a
    grid has cells.
    """
    first_seen = points.groupBy(*keys, grid, "eci").agg(F.min(line.stamp).alias("_at"))
    listed = first_seen.groupBy(*keys, grid).agg(
        F.array_sort(F.collect_list(F.struct("_at", "eci"))).alias("_seen")
    )
    return listed.select(
        *keys, grid, F.array_join(F.transform("_seen", lambda s: s["eci"]), "#").alias("ecis")
    )


def merge_traces_across_days(
    left: DataFrame, right: DataFrame, line: Timeline = LIFETIME
) -> DataFrame:
    """Append two traces of each subscriber, whichever comes first.

    The touching stays merge when their codes match.  A pair of traces that overlaps in time is
    not merged: the left one is kept unchanged.  Subscribers in one input only pass through.
    """
    both = left.withColumn("_side", F.lit(0)).unionByName(right.withColumn("_side", F.lit(1)))
    return append_traces(both, "_side", line, in_time=False).drop("_side")


def append_traces(
    stays: DataFrame,
    trace: str = "date",
    line: Timeline = LIFETIME,
    in_time: bool = True,
    meridian: float = geo.CENTRAL_MERIDIAN,
) -> DataFrame:
    """Append all traces of each subscriber, one for each value of ``trace``.

    Traces are taken in order of their start (or of ``trace``); one that overlaps what is there by
    then is left out.  Where a trace ends and the next begins at one code, the two touching stays
    merge as in ``merge_adjacent_stays``; no other stay changes.
    """
    day = Timeline((*line.keys, trace), line.order, line.slice_ms)
    rows = day.dealt(stays)
    kept = rows.join(_slices_of_kept_traces(rows, trace, line, day, in_time), day.here, "left_semi")
    located = geo.with_metres(kept, x="_x", y="_y", meridian=meridian)
    rows = neighbours(located, day, before={"_b": F.lit(True)}, after={"_a": F.lit(True)})
    first, last = F.col("_b").isNull(), F.col("_a").isNull()
    # Only the ends of traces meet; what lies inside stays with its slice.
    inside = F.when(~first & ~last, F.struct(trace, F.floor(F.col("s_time") / F.lit(line.slice_ms))))
    rows = rows.withColumns({"_first_of": first, "_last_of": last, "_inside": inside})
    group = [*line.keys, "_inside"]
    ends = Window.partitionBy(*group).orderBy(*line.order, F.desc("_first_of"))
    came = F.lag(F.struct("code", F.col(trace).alias("trace"), "_last_of")).over(ends)
    touches = (
        F.col("_first_of")
        & F.col("_came._last_of")
        & ~F.col("_came.trace").eqNullSafe(F.col(trace))
        & (F.col("_came.code") == F.col("code"))
    )
    rows = rows.withColumn("_came", came)
    rows = rows.withColumn("_new", (~F.coalesce(touches, F.lit(False))).cast("int"))
    rows = rows.withColumn("_run", F.sum("_new").over(ends))
    place = F.struct(
        line.stamp.alias("at"),
        F.col("_x").isNotNull().cast("int").alias("n"),
        (F.col("_x") / 2).alias("sx"),
        (F.col("_y") / 2).alias("sy"),
        F.col("_x").alias("x1"),
        F.col("_y").alias("y1"),
    )
    columns = [c for c in stays.columns if c not in line.keys]
    scene = [F.max(F.col("scene") == INDOOR).alias("_indoor"), F.max(F.struct(line.stamp, "scene")).alias("_last")]
    merged = rows.groupBy(*group, "_run").agg(
        F.min_by(F.struct(*columns), line.stamp).alias("_first"),
        F.count(F.lit(1)).alias("_stays"),
        F.max("e_time").alias("_end"),
        F.collect_list(place).alias("_middle"),
        *(scene if "scene" in columns else []),
    )
    merged = merged.withColumn("_mid", _folded_center(F.col("_middle")))
    merged = geo.with_degrees(merged, "_mid.x", "_mid.y", "_lon", "_lat", meridian)
    changed = {
        "e_time": F.col("_end"),
        "duration": F.col("_end") - F.col("_first.s_time"),
        "lon": F.col("_lon"),
        "lat": F.col("_lat"),
        "scene": _scene() if "scene" in columns else None,
    }
    alone = F.col("_stays") == 1

    def value(c: str) -> Column:
        first = F.col("_first")[c]
        return F.when(alone, first).otherwise(changed[c]) if c in changed else first

    return merged.select(*line.keys, *[value(c).alias(c) for c in columns])


def _slices_of_kept_traces(
    rows: DataFrame, trace: str, line: Timeline, day: Timeline, in_time: bool
) -> DataFrame:
    """Slices of the traces that do not overlap what was appended before them.

    A subscriber's traces are folded as a list of their spans, which has one entry a trace.
    """
    slices = rows.groupBy(*day.here).agg(
        F.min("s_time").alias("_from"), F.max("e_time").alias("_to"), F.max(day.row).alias("_pin")
    )
    spans = slices.groupBy(*day.whole).agg(
        F.min("_from").alias("from"), F.max("_to").alias("to"), F.max("_pin").alias("pin")
    )
    order = F.col("from") if in_time else F.col(day.trace)[trace]
    entry = F.struct(order.alias("order"), "from", "to", "pin", *day.whole)
    listed = spans.groupBy(*[F.col(day.trace)[k].alias(k) for k in line.keys]).agg(
        F.array_sort(F.collect_list(entry)).alias("all")
    )
    whole = F.struct(*[F.col("all")[0][c].alias(c) for c in day.whole])
    start = F.struct(
        F.col("all")[0]["from"].alias("from"),
        F.col("all")[0]["to"].alias("to"),
        F.array(whole).alias("kept"),
    )

    def step(acc: Column, t: Column) -> Column:
        apart = (t["from"] > acc["to"]) | (t["to"] < acc["from"])
        own = F.struct(*[t[c].alias(c) for c in day.whole])
        longer = F.struct(
            F.least(acc["from"], t["from"]).alias("from"),
            F.greatest(acc["to"], t["to"]).alias("to"),
            F.concat(acc["kept"], F.array(own)).alias("kept"),
        )
        return F.when(apart, longer).otherwise(acc)

    rest = F.slice(F.col("all"), 2, F.greatest(F.size("all") - 1, F.lit(1)))
    kept = listed.select(F.inline(F.aggregate(rest, start, step)["kept"]))
    return slices.select(*day.here).join(kept, day.whole)


def coordinate_text(lon: Column, lat: Column, alt: Column | None = None) -> Column:
    """``lon,lat,alt`` with blanks for what is missing."""
    blank = F.lit("")
    return F.concat_ws(
        ",",
        F.coalesce(lon.cast("string"), blank),
        F.coalesce(lat.cast("string"), blank),
        F.coalesce(alt.cast("string"), blank) if alt is not None else blank,
    )


def stay_text() -> Column:
    """``lon,lat,alt,code,start,end,duration,scene`` of a stay row."""
    blank = F.lit("")

    def time(c: str) -> Column:
        return F.when(F.col(c) != 0, F.col(c).cast("string")).otherwise(blank)

    return F.concat_ws(
        ",",
        coordinate_text(F.col("lon"), F.col("lat")),
        F.coalesce(F.col("code"), blank),
        time("s_time"),
        time("e_time"),
        F.col("duration").cast("string"),
        F.when(F.col("scene") == INDOOR, INDOOR).otherwise(ROAD),
    )


def trace_serialise(
    stays: DataFrame,
    kind: str = "SECTOR",
    line: Timeline = DAILY,
    part_ms: int = PART_MS,
) -> DataFrame:
    """Trace text ``imsi,kind#stay#stay...``.

    A trace has one row for each stretch of ``part_ms`` in which a stay starts, each with the head, so
    a text is bounded by its stretch; ``part`` numbers the stretches from the epoch.
    """
    order = F.struct(*line.order, F.coalesce("code", F.lit("")).alias("code"))
    part = F.floor(F.col("s_time") / F.lit(part_ms))
    rows = stays.withColumns({"part": part.cast("bigint"), "_pos": order, "_text": stay_text()})
    texts = rows.groupBy(*line.keys, "part").agg(
        F.array_sort(F.collect_list(F.struct("_pos", "_text"))).alias("_stays")
    )
    body = F.array_join(F.transform("_stays", lambda s: s["_text"]), "#")
    head = F.concat_ws(",", "imsi", F.lit(kind))
    return texts.select(*line.keys, "part", F.concat(head, F.lit("#"), body).alias("trace"))


def stay_count_per_trace(
    stays: DataFrame, keys: tuple[str, ...] = ("imsi", "date")
) -> DataFrame:
    return stays.groupBy(*keys).agg(F.count(F.lit(1)).alias("stays"))


def traces_on_road(stays: DataFrame, keys: tuple[str, ...] = ("imsi", "date")) -> DataFrame:
    """Whether a trace never goes indoors."""
    return stays.groupBy(*keys).agg(
        (~F.max(F.coalesce(F.col("scene") == INDOOR, F.lit(False)))).alias("on_road")
    )


def empty_traces(traces: DataFrame, stays: DataFrame, keys=("imsi", "date")) -> DataFrame:
    """Traces that have no stay."""
    return traces.select(*keys).distinct().join(stays, list(keys), "left_anti")
