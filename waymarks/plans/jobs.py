"""The batch jobs, each one declarative plan from its input rows to its output table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymarks.functions import geo, geohash
from waymarks.functions.calendar import SHANGHAI, Clock
from waymarks.operators import clean
from waymarks.operators import stays as S
from waymarks.operators.dims import cell_keys, one_row_per_cell
from waymarks.operators.ordered import DAILY, Timeline

# ---- fixed values: country codes and source marks of the published tables ------------------
COUNTRY_OF_POINTS = "CN"
COUNTRY_OF_TEXT = "CHN"
COUNTRY_OF_TICKETS = "86"
SOURCE_OF_TICKETS = "bill"
SOURCE_OF_GRIDS = "MR"
# ---- end of fixed values -------------------------------------------------------------------

GRID_DAY = Timeline(keys=("imsi", "day_id"))
GRID_HOUR = Timeline(keys=("imsi", "day_id", "hour_id"))
IDENTITY = Timeline(keys=("phone", "imsi", "imei", "date"))
TICKET = Timeline(keys=("imsi", "phone", "date"))


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def cell_stay_table(
    points: DataFrame,
    area: DataFrame,
    line: Timeline = DAILY,
    ping_pong: bool = False,
    geohash_compat: bool = False,
) -> DataFrame:
    """Located points to cell stays with position, geohash, city and county.

    ``ping_pong`` first rewrites A, B, A flip-flops.
    """
    if ping_pong:
        points = S.suppress_ping_pong(points, line)
    stays = S.stay_aggregate(points, line)
    places = one_row_per_cell(area.select("code", "rat", "city_id", "county_id"))
    return stays.join(places, ["code", "rat"], "left").select(
        "imsi",
        "date",
        F.lit("").alias("msisdn"),
        F.lit("").alias("imei"),
        F.col("code").alias("lac_cell"),
        "rat",
        F.col("lon").alias("longitude"),
        F.col("lat").alias("latitude"),
        geohash.encode(F.col("lon"), F.col("lat"), geohash_compat).alias("geohash"),
        F.lit(COUNTRY_OF_POINTS).alias("country_code"),
        F.coalesce("city_id", F.lit("")).alias("city_code"),
        F.coalesce("county_id", F.lit("")).alias("county_code"),
        F.col("s_time").alias("enter_time"),
        F.col("e_time").alias("leave_time"),
        "source",
    )


def cell_stay_table_text(
    intervals: DataFrame,
    sites: DataFrame,
    counties: DataFrame,
    line: Timeline = IDENTITY,
    geohash_compat: bool = False,
) -> DataFrame:
    """Signalling text rows to merged cell stays with geohash and county.

    ``sites``: ``eci``, lon, lat; rows of unknown cells are dropped, and so is a whole trace with
    any impossible coordinate.  ``counties``: ``code`` and ``county_id``.
    """
    located = sites.groupBy("eci").agg(F.min(F.struct("lon", "lat")).alias("_at"))
    known = intervals.join(located.where(F.col("eci").isNotNull()), "eci").withColumns(
        {
            "code": F.col("eci").cast("string"),
            "lon": F.col("_at.lon"),
            "lat": F.col("_at.lat"),
        }
    ).drop("_at")
    by_end = line.ordered_by("e_time", "s_time", "event_id")
    located = clean.drop_bad_coordinate_traces(known, by_end, dealt=True)
    merged = S.merge_adjacent_stays(located, by_end)
    return (
        merged.where(~F.col("code").contains("-"))
        .join(one_row_per_cell(counties.select("code", "county_id"), ("code",)), "code", "left")
        .select(
            "imsi",
            "phone",
            "imei",
            "date",
            F.col("code").alias("cell"),
            F.col("lon").alias("longitude"),
            F.col("lat").alias("latitude"),
            geohash.encode(F.col("lon"), F.col("lat"), geohash_compat).alias("geohash"),
            F.lit(COUNTRY_OF_TEXT).alias("country_code"),
            F.coalesce("county_id", F.lit("")).alias("county_code"),
            F.col("s_time").alias("enter_time"),
            F.col("e_time").alias("leave_time"),
        )
    )


def _grid_row(stays: DataFrame, clock: Clock, size: int, meridian: float) -> DataFrame:
    placed = geo.with_grid_origin(stays, "code", "_glon", "_glat", size, meridian)
    return placed.select(
        F.lit("").alias("calling_no"),
        F.col("code").alias("grid"),
        F.lit("").alias("calling_imei"),
        F.col("imsi").alias("calling_imsi"),
        F.col("_glon").alias("lon"),
        F.col("_glat").alias("lat"),
        clock.second_label(F.col("s_time")).alias("start_time"),
        F.floor((F.col("e_time") - F.col("s_time")) / F.lit(1000)).alias("stay_time"),
        clock.second_label(F.col("e_time")).alias("end_time"),
        "ecis",
        F.lit(SOURCE_OF_GRIDS).alias("source"),
        *[c for c in ("event_id", "s_time", "e_time", "day_id", "hour_id") if c in stays.columns],
    )


def grid_trace_hour(
    points: DataFrame,
    line: Timeline = GRID_HOUR,
    clock: Clock = SHANGHAI,
    size: int = geo.GRID_SIZE,
    meridian: float = geo.CENTRAL_MERIDIAN,
) -> DataFrame:
    """Measurement-report points of each hour to grid stays with the cells seen in the grid."""
    gridded = clean.grid_assign_xy(clean.filter_location_type(points), size, meridian, "code")
    stays = S.stay_aggregate(gridded, line, meridian=meridian)
    cells = S.cells_per_grid(gridded, line.keys, line, grid="code")
    return _grid_row(stays.join(cells, [*line.keys, "code"]), clock, size, meridian)


def grid_trace_day(
    grid_stays: DataFrame,
    clock: Clock = SHANGHAI,
    size: int = geo.GRID_SIZE,
    meridian: float = geo.CENTRAL_MERIDIAN,
    compat: bool = False,
    line: Timeline = GRID_DAY,
) -> DataFrame:
    """Hourly grid stays of a day to one trace per subscriber and day.

    Stays of another day than their partition's are dropped.  ``compat`` also drops
    subscribers with a single stay.
    """
    rows = grid_stays.select(
        F.col("calling_imsi").alias("imsi"),
        "day_id",
        "event_id",
        F.col("grid").alias("code"),
        "s_time",
        "e_time",
        "lon",
        "lat",
        "ecis",
    )
    kept = clean.guard_day(rows, F.col("day_id"), clock)
    if compat:
        kept = S.smooth_overlaps(kept, line, drop_single=True)
    merged = S.merge_adjacent_stays(kept, line, smooth=not compat, midpoint=False)
    return _grid_row(merged, clock, size, meridian)


def _stay_row(stays: DataFrame, source: Column) -> DataFrame:
    return stays.select(
        "imsi",
        "date",
        F.col("phone").alias("msisdn"),
        F.lit("").alias("imei"),
        F.col("code").alias("lac_cell"),
        F.lit(COUNTRY_OF_TICKETS).alias("country_code"),
        "city_code",
        "county_code",
        F.col("s_time").alias("enter_time"),
        F.col("e_time").alias("leave_time"),
        source.alias("source"),
    )


def ticket_trace(
    local_voice: DataFrame,
    local_data: DataFrame,
    out_voice: DataFrame,
    out_data: DataFrame,
    clock: Clock = SHANGHAI,
    compat: bool = False,
    line: Timeline = TICKET,
) -> DataFrame:
    """Four ticket tables to stays of decoded cells, as the published table."""
    merged = merged_tickets(local_voice, local_data, out_voice, out_data, clock, compat, line)
    return _stay_row(merged, F.lit(SOURCE_OF_TICKETS))


def merged_tickets(
    local_voice: DataFrame,
    local_data: DataFrame,
    out_voice: DataFrame,
    out_data: DataFrame,
    clock: Clock = SHANGHAI,
    compat: bool = False,
    line: Timeline = TICKET,
) -> DataFrame:
    """Stays of decoded cells of all tickets, overlaps cut and neighbours merged."""
    decoded = [
        clean.ticket_stays(t, service, clock, compat)
        for t, service in (
            (local_voice, "voice"),
            (local_data, "data"),
            (out_voice, "voice"),
            (out_data, "data"),
        )
    ]
    rows = reduce(DataFrame.unionByName, decoded).select(
        "imsi",
        "phone",
        clock.day_text(F.col("s_time")).alias("date"),
        "event_id",
        "code",
        "s_time",
        "e_time",
        "city_code",
        "county_code",
    )
    return S.merge_adjacent_stays(rows, line, smooth=True, midpoint=False)


def merge_ticket_and_location(
    ticket_stays: DataFrame,
    located_stays: DataFrame,
    line: Timeline = DAILY,
    geohash_compat: bool = False,
) -> DataFrame:
    """Union of ticket and located stays, overlaps cut and neighbours merged.

    Both inputs: keys, event_id, code, s_time, e_time, lon, lat and source; ticket stays have
    no position, which merging skips.
    """
    both = ticket_stays.unionByName(located_stays, allowMissingColumns=True)
    merged = S.merge_adjacent_stays(both, line, smooth=True)
    return merged.withColumn(
        "geohash",
        F.coalesce(geohash.encode(F.col("lon"), F.col("lat"), geohash_compat), F.lit("")),
    )


def point_trace_text(
    points: DataFrame,
    kind: str = "SECTOR",
    line: Timeline = DAILY,
    where: Column | None = None,
    part_ms: int = S.PART_MS,
) -> DataFrame:
    """Points, optionally filtered, to trace texts, one for each stretch of a subscriber's day."""
    kept = points if where is None else points.where(where)
    return S.trace_serialise(S.stay_aggregate(kept, line), kind, line, part_ms)


def interval_trace_count(
    intervals: DataFrame, sites: DataFrame, line: Timeline = Timeline(keys=("phone", "date"))
) -> DataFrame:
    """Signalling intervals to the number of merged stays per phone and day.

    Both sides have ``eci``; rows of cells that ``sites`` does not know are dropped.
    """
    by_end = line.ordered_by("e_time", "s_time", "event_id")
    known = intervals.join(sites.select("eci"), "eci", "left_semi")
    merged = S.merge_adjacent_stays(
        known.withColumn("code", F.col("eci").cast("string")), by_end, midpoint=False
    )
    return S.stay_count_per_trace(merged, line.keys)


def single_area_subscribers(
    stays: DataFrame, area: DataFrame, line: Timeline = DAILY
) -> DataFrame:
    """Subscribers who stayed in one area all day.

    A trace is one merged stay exactly when all its stays have one area, so counting areas
    needs no ordering.  Places outside the area table do not count as an area.
    """
    keys = cell_keys(stays, area)
    areas = one_row_per_cell(area.select(*keys, "area_code"), tuple(keys))
    labelled = stays.join(areas, keys, "left")
    area_code = F.coalesce(F.col("area_code"), F.lit(""))
    return (
        labelled.groupBy(*line.keys)
        .agg(
            F.min(area_code).alias("area_code"),
            F.max(area_code).alias("_other"),
            F.min("s_time").alias("s_time"),
            F.max("e_time").alias("e_time"),
        )
        .where(F.col("area_code") == F.col("_other"))
        .drop("_other")
    )


def secondary_sort(rows: DataFrame, group: str, score: str, tie: tuple[str, ...] = ()) -> DataFrame:
    """Rows grouped by key, each group by score descending; an unreadable score counts as 0.

    A range sort: a large group spreads over several partitions, still in order.
    """
    number = F.coalesce(F.col(score).try_cast("int"), F.lit(0))
    return rows.withColumn(score, number).orderBy(group, F.desc(score), *tie)
