"""Projections, filters and normalisation of raw rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymarks.functions import cells as C
from waymarks.functions import geo
from waymarks.functions.calendar import SHANGHAI, Clock
from waymarks.operators.intervals import spread_join
from waymarks.operators.ordered import DAILY, Timeline, annotate

PLACE_KINDS = ("AOI", "GRID", "SECTOR")


def classify_source(points: DataFrame, loc_type: str = "loc_type") -> DataFrame:
    return points.withColumn("source", C.source_of(F.col(loc_type)))


def filter_location_type(
    points: DataFrame, types: tuple[str, ...] = C.MR_TYPES, loc_type: str = "loc_type"
) -> DataFrame:
    return points.where(F.col(loc_type).isin(*types))


def classify_rat(points: DataFrame, cell: str = "cell") -> DataFrame:
    return points.withColumn("rat", C.rat_of(F.col(cell)))


def normalise_cell_id(points: DataFrame, cell: str = "cell") -> DataFrame:
    return points.withColumn("cell_number", C.cell_number(F.col(cell)))


def site_of_cell(points: DataFrame, eci: str = "eci") -> DataFrame:
    return points.withColumn("site", C.site_of(F.col(eci)))


def ticket_stays(
    tickets: DataFrame, service: str, clock: Clock = SHANGHAI, compat: bool = False
) -> DataFrame:
    """Tickets of one service as stays: decoded cell, start and end in milliseconds.

    ``tickets``: hexadecimal ``lac`` and ``cell``, ``start_text`` as yyyyMMddHHmmss, ``seconds``.
    """
    lac, cell = F.col("lac"), F.col("cell")
    code = C.voice_cell(lac, cell, compat) if service == "voice" else C.data_cell(lac, cell)
    return ticket_interval(tickets.withColumn("code", code), clock)


def ticket_interval(tickets: DataFrame, clock: Clock = SHANGHAI) -> DataFrame:
    start = clock.parse(F.col("start_text"), "yyyyMMddHHmmss")
    return tickets.withColumn("s_time", start).withColumn(
        "e_time", F.col("s_time") + F.coalesce(F.col("seconds"), F.lit(0)) * 1000
    )


def _scene(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(trimmed.isin("ROAD", "INDOOR"), trimmed)


def parse_location_csv(lines: DataFrame) -> DataFrame:
    """Comma lines (column ``value``) to located events; fields that cannot be read are NULL.

    Fields: 0 imsi, 1 start, 2 end, 4 cell, 6 scene, 7 session, 8 longitude, 9 latitude.
    """
    part = F.split("value", ",")
    return lines.select(
        F.get(part, 0).alias("imsi"),
        _number(part, 1).alias("s_time"),
        _number(part, 2).alias("e_time"),
        _number(part, 4).alias("eci"),
        _scene(F.get(part, 6)).alias("scene"),
        _number(part, 7, "int").alias("session"),
        _number(part, 8, "double").alias("lon"),
        _number(part, 9, "double").alias("lat"),
    )


def _number(part: Column, i: int, kind: str = "bigint") -> Column:
    """Field ``i`` as a number; NULL when it is missing, blank or unreadable."""
    return F.get(part, i).try_cast(kind)


def expand_source_target_cell(lines: DataFrame) -> DataFrame:
    """A source-cell event per line and, when field 5 names a target cell, a second event there.

    The target event happens at the end time; its position is left for a cell-table lookup.  Fields that
    cannot be read are NULL, and a blank or missing target is none.
    """
    part = F.split("value", ",")
    nothing = F.lit(None)

    def event(role, start, cell, lon, lat):
        return F.struct(
            F.lit(role).alias("role"),
            start.alias("s_time"),
            _number(part, 2).alias("e_time"),
            cell.alias("eci"),
            lon.cast("double").alias("lon"),
            lat.cast("double").alias("lat"),
        )

    position = [_number(part, i, "double") for i in (8, 9)]
    source = event("source", _number(part, 1), _number(part, 4), *position)
    target = event("target", _number(part, 2), _number(part, 5), nothing, nothing)
    named = F.trim(F.coalesce(F.get(part, 5), F.lit("")))
    events = F.when(named.isin("", C.NO_TARGET_CELL), F.array(source)).otherwise(
        F.array(source, target)
    )
    return lines.select(
        F.get(part, 0).alias("imsi"),
        _scene(F.get(part, 6)).alias("scene"),
        _number(part, 7, "int").alias("session"),
        F.inline(events),
    )


def place_code(points: DataFrame, kind: str) -> DataFrame:
    """Use the AOI, grid or cell code as the place code."""
    column = {"AOI": "aoi_code", "GRID": "grid_code", "SECTOR": "eci"}[kind]
    return points.withColumn("code", F.col(column).cast("string"))


def guard_day(stays: DataFrame, day: Column, clock: Clock = SHANGHAI) -> DataFrame:
    """Drop rows without a subscriber, and stays that start on another day than the job's."""
    return stays.where(
        F.col("imsi").isNotNull()
        & (F.col("imsi") != "")
        & (clock.day_text(F.col("s_time")) == day)
    )


def drop_bad_coordinate_traces(
    stays: DataFrame, line: Timeline = DAILY, dealt: bool = False
) -> DataFrame:
    """Drop every trace with any longitude or latitude below 0 or above 180.

    A trace whose key is NULL is a trace like any other.  ``dealt`` keeps the columns by which rows are
    dealt, so that a next step along ``line`` needs no shuffle.
    """
    outside = ~F.col("lon").between(0, 180) | ~F.col("lat").between(0, 180)
    rows = annotate(stays, line, anywhere={"_bad": outside}).where(~F.col("_bad")).drop("_bad")
    return rows if dealt else line.unsliced(rows)


def require_full_identity(
    stays: DataFrame, columns: tuple[str, ...] = ("phone", "imsi", "imei", "date")
) -> DataFrame:
    for c in columns:
        stays = stays.where(F.col(c).isNotNull() & (F.col(c) != ""))
    return stays


def to_string_row(df: DataFrame) -> DataFrame:
    """Every column as text with NULL as the empty text, for text and all-string sinks."""
    return df.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns]
    )


def keep_cells_in_dim(points: DataFrame, dim: DataFrame, on="code") -> DataFrame:
    return points.join(dim.select(on) if isinstance(on, str) else dim.select(*on), on, "left_semi")


def grid_assign(
    points: DataFrame,
    size: int = geo.GRID_SIZE,
    meridian: float = geo.CENTRAL_MERIDIAN,
    out: str = "grid_code",
) -> DataFrame:
    located = geo.with_metres(points, x="_x", y="_y", meridian=meridian)
    return located.withColumn(out, geo.grid_code("_x", "_y", size)).drop("_x", "_y")


def grid_assign_xy(
    points: DataFrame,
    size: int = geo.GRID_SIZE,
    meridian: float = geo.CENTRAL_MERIDIAN,
    out: str = "grid",
) -> DataFrame:
    located = geo.with_metres(points, x="_x", y="_y", meridian=meridian)
    return located.withColumn(out, geo.grid_code_xy("_x", "_y", size)).drop("_x", "_y")


def grid_indoor_session(
    points: DataFrame,
    session: tuple[str, ...] = ("imsi", "date"),
    order: tuple[str, ...] = ("s_time", "event_id"),
    size: int = geo.GRID_SIZE,
    meridian: float = geo.CENTRAL_MERIDIAN,
) -> DataFrame:
    """One grid for a session that starts indoors (its centroid's), else a grid per event."""
    located = geo.with_metres(points, x="_x", y="_y", meridian=meridian)
    sessions = located.groupBy(*session).agg(
        F.min_by("scene", F.struct(*order)).alias("_first_scene"),
        F.avg("_x").alias("_cx"),
        F.avg("_y").alias("_cy"),
    )
    indoor = F.col("_first_scene") == "INDOOR"
    return (
        located.join(sessions, list(session))
        .withColumn(
            "grid_code",
            geo.grid_code(
                F.when(indoor, F.col("_cx")).otherwise(F.col("_x")),
                F.when(indoor, F.col("_cy")).otherwise(F.col("_y")),
                size,
            ),
        )
        .drop("_x", "_y", "_cx", "_cy", "_first_scene")
    )


def centroid(
    points: DataFrame, keys: tuple[str, ...], meridian: float = geo.CENTRAL_MERIDIAN
) -> DataFrame:
    """Mean of the projected points of a group, as longitude and latitude."""
    located = geo.with_metres(points.select(*keys, "lon", "lat"), meridian=meridian)
    means = located.groupBy(*keys).agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    return geo.with_degrees(means, meridian=meridian).select(*keys, "lon", "lat")


def cells_within_radius(
    cells: DataFrame,
    lon: float,
    lat: float,
    radius: float,
    meridian: float = geo.CENTRAL_MERIDIAN,
) -> DataFrame:
    """Cells nearer than ``radius`` metres to a point, with their distance.

    A box in degrees, which the scan can use, comes before the exact distance.
    """
    # A degree of latitude is at least 110 km; widen the box a little for the projection.
    reach = radius / 110_000 * 1.05
    box = F.col("lat").between(lat - reach, lat + reach)
    furthest = max(abs(lat - reach), abs(lat + reach))
    if furthest < 89:
        # Meridians draw together towards the poles; a box over the date line has two parts.
        wide = reach / math.cos(math.radians(furthest))
        apart = F.abs(F.col("lon") - lon)
        if wide < 180:
            box = box & ((apart <= wide) | (apart >= 360 - wide))
    near = geo.with_metres(cells.where(box), x="_x", y="_y", meridian=meridian)
    near = geo.with_metres(near, F.lit(lon), F.lit(lat), "_cx", "_cy", meridian)
    near = near.withColumn("distance", geo.euclid("_x", "_y", "_cx", "_cy"))
    return near.where(F.col("distance") < radius).drop("_x", "_y", "_cx", "_cy")


def cells_near_places(
    cells: DataFrame,
    places: DataFrame,
    radius: float,
    meridian: float = geo.CENTRAL_MERIDIAN,
) -> DataFrame:
    """Cells nearer than ``radius`` metres to each of many places (``place``, lon, lat).

    Both sides are dealt to squares of ``radius`` metres in the projection in which distances are
    measured.  A place looks into its own square and the ring around it, so the join is on equal squares
    and each pair is met once; a square with many cells and places is dealt over many tasks.
    """
    here = geo.with_metres(cells, x="_x", y="_y", meridian=meridian)
    there = geo.with_metres(
        places.select("place", F.col("lon").alias("_plon"), F.col("lat").alias("_plat")),
        "_plon", "_plat", "_px", "_py", meridian,
    )

    def square(c: str) -> Column:
        return F.floor(F.col(c) / F.lit(float(radius)))

    ring = F.array(*[
        F.struct((square("_px") + i).alias("_sx"), (square("_py") + j).alias("_sy"))
        for i in (-1, 0, 1)
        for j in (-1, 0, 1)
    ])
    met = spread_join(
        here.withColumns({"_sx": square("_x"), "_sy": square("_y")}),
        there.select("place", "_px", "_py", F.inline(ring)),
        ("_sx", "_sy"),
    )
    distance = geo.euclid("_x", "_y", "_px", "_py")
    return met.withColumn("distance", distance).where(F.col("distance") < radius).drop(
        "_x", "_y", "_px", "_py", "_sx", "_sy"
    )
