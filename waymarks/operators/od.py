"""Origin-destination tables: passages between two places and changes of area along a trace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymarks.functions import geo
from waymarks.functions.calendar import MINUTE_MS
from waymarks.operators import stays as S
from waymarks.operators.dims import one_row_per_cell
from waymarks.operators.ordered import DAILY, Timeline, annotate, neighbours
from waymarks.operators.traces import passages

PHONE = Timeline(keys=("phone",))
HOME_COUNTRY = "86"


def od_legs(stays: DataFrame, origin: Column, destination: Column, line: Timeline = DAILY):
    """Origin and destination stay of every passage."""
    return passages(stays, origin, destination, line).select(*line.keys, "o", "d")


def od_behaviour(legs: DataFrame, meridian: float = geo.CENTRAL_MERIDIAN) -> DataFrame:
    """Travel time and distances of every leg."""
    ends = geo.with_metres(legs, "o.lon", "o.lat", "_ox", "_oy", meridian)
    ends = geo.with_metres(ends, "d.lon", "d.lat", "_dx", "_dy", meridian)
    return ends.select(
        *[c for c in legs.columns if c not in ("o", "d")],
        F.col("o.event_id").alias("o_event_id"),
        F.col("o.code").alias("o_code"),
        F.col("d.code").alias("d_code"),
        (F.col("d.s_time") - F.col("o.e_time")).alias("time_ms"),
        geo.euclid("_ox", "_oy", "_dx", "_dy").alias("distance"),
        geo.manhattan("_ox", "_oy", "_dx", "_dy").alias("manhattan_distance"),
    )


def od_summary(behaviour: DataFrame) -> DataFrame:
    """Distinct users and mean time and distances of each pair of places."""
    return behaviour.groupBy("o_code", "d_code").agg(
        F.count_distinct("imsi").alias("users"),
        F.floor(F.avg("time_ms")).alias("mean_time_ms"),
        F.avg("distance").alias("mean_distance"),
        F.avg("manhattan_distance").alias("mean_manhattan"),
    )


_SIDE = ("code", "place_code", "place_name", "place_scene", "s_time", "e_time", "_x", "_y")


def od_changes(
    stays: DataFrame,
    line: Timeline = DAILY,
    skip_blank: bool = False,
    compat: bool = False,
    changed_on: str = "place_code",
    meridian: float = geo.CENTRAL_MERIDIAN,
) -> DataFrame:
    """Every change of place along a trace, with the origin and destination stay.

    ``stays`` carries ``place_code``, ``place_name`` and ``place_scene``.  The origin is the stay
    before; the first stay is not a change.  ``skip_blank``: stays without a place neither end
    a change nor serve as its origin.  ``compat`` keeps the older row-position rule: the first
    stay with a place gives a pair with itself, and so does any change at the first, second or
    last row of the trace.
    """
    label = F.coalesce(F.col(changed_on), F.lit(""))
    rows = geo.with_metres(stays, x="_x", y="_y", meridian=meridian)
    here = F.struct(*_SIDE)
    rows = rows.withColumns({"_label": label, "_here": here})
    known = F.col("_label") != ""
    seen = {"o": F.col("_here"), "_was": F.col("_label")}
    if skip_blank:
        kept = {n: F.when(known, c) for n, c in seen.items()}
        rows = annotate(
            rows,
            line,
            before={"_row_before": F.col("_here")} if compat else None,
            last_before=kept,
            position="_pos" if compat else None,
            size="_size" if compat else None,
        )
    elif compat:
        rows = annotate(rows, line, before=seen, position="_pos", size="_size")
    else:
        rows = neighbours(rows, line, before=seen)
    was = F.coalesce(F.col("_was"), F.lit(""))
    turn = F.col("_label") != was
    if skip_blank:
        turn = turn & known
    if compat:
        edge = (F.col("_pos") <= 2) | (F.col("_pos") == F.col("_size"))
        before = F.col("_row_before") if skip_blank else F.col("o")
        rows = rows.where(turn).withColumn(
            "o", F.when(edge, F.col("_here")).otherwise(before)
        )
    else:
        rows = rows.where(turn & F.col("o").isNotNull())
    return line.unsliced(rows.withColumn("d", F.col("_here"))).drop(
        "_label", "_here", "_was", "_pos", "_size", "_x", "_y", "_row_before"
    )


def od_table(changes: DataFrame, level: str, measured: bool = True) -> DataFrame:
    """Changes as the published table: who, both ends, distance, duration and speed."""
    seconds = F.floor((F.col("d.s_time") - F.col("o.e_time")) / F.lit(1000)).cast("double")
    metres = geo.euclid("o._x", "o._y", "d._x", "d._y")

    def side(s: str) -> list[Column]:
        p = s.upper()
        return [
            F.col(f"{s}.code").alias(f"{p}_cellID"),
            F.col(f"{s}.place_code").alias(f"{p}_{level}_code"),
            F.col(f"{s}.place_name").alias(f"{p}_{level}_name"),
            F.col(f"{s}.place_scene").alias(f"{p}_cell_state"),
            F.col(f"{s}.s_time").alias(f"{p}_in_time"),
            F.col(f"{s}.e_time").alias(f"{p}_out_time"),
        ]

    def optional(name: str) -> Column:
        return F.col(name) if name in changes.columns else F.lit(None).cast("string")

    who = [
        F.col("date").alias("date_day"),
        optional("imsi").alias("imsi"),
        optional("phone").alias("msisdn"),
    ]
    speed = F.when(seconds != 0, F.round(metres / seconds, 2))
    measures = [
        F.round(metres / 1000, 6).alias(f"OD_{level}_distance"),
        F.round(seconds / 3600, 2).alias(f"OD_{level}_duration"),
        speed.alias(f"OD_{level}_velocity"),
    ]
    tail = [
        F.lit("").alias(f"OD_{level}_type"),
        optional("home_province").alias("home_province"),
    ]
    return changes.select(*who, *side("o"), *side("d"), *(measures if measured else []), *tail)


def area_od(
    stays: DataFrame,
    dim: DataFrame,
    level: str,
    line: Timeline = DAILY,
    compat: bool = False,
) -> DataFrame:
    """County or city OD: cell stays, labelled by cell and technology, and their changes."""
    labels = one_row_per_cell(
        dim.select(
            "code",
            "rat",
            F.col(f"{level}_id").alias("place_code"),
            F.col(f"{level}_name").alias("place_name"),
            F.col("scene_name").alias("place_scene"),
        )
    )
    labelled = stays.join(labels, ["code", "rat"], "left")
    return od_table(od_changes(labelled, line, compat=compat), level)


# ---- roaming ---------------------------------------------------------------------------


def local_phone(signalling: DataFrame) -> DataFrame:
    """Phone number without the two-digit country prefix."""
    return signalling.withColumn("phone", F.expr("substring(msisdn, 3)"))


def _roaming_places(roaming: DataFrame, level: str) -> DataFrame:
    """Roaming rows with the place columns of one level."""
    if level == "province":
        place = {"place_code": F.col("province_code"), "place_name": F.col("province_name")}
    else:
        place = {
            "place_code": F.col("country_code"),
            "place_name": F.concat_ws("|", "country_name", "country_name_en"),
        }
    return roaming.withColumns({**place, "place_scene": F.lit("")})


def roaming_in_force(
    signalling: DataFrame, roaming: DataFrame, level: str, line: Timeline = PHONE
) -> DataFrame:
    """Signalling rows with the latest roaming row of their phone that had begun by then."""
    places = _roaming_places(roaming, level)
    visit = F.struct(
        "place_code",
        "place_name",
        "place_scene",
        F.col("s_time").alias("r_start"),
        F.col("e_time").alias("r_end"),
    )
    row = [c for c in signalling.columns if c not in ("phone", "s_time", "event_id")]
    begun = places.select("phone", "s_time", "event_id", visit.alias("_visit"))
    both = signalling.withColumn("_kind", F.lit(1)).unionByName(
        begun.withColumn("_kind", F.lit(0)), allowMissingColumns=True
    )
    order = line.ordered_by(line.order[0], "_kind", *line.order[1:])
    filled = annotate(both, order, last_upto={"_now": F.col("_visit")})
    return order.unsliced(filled.where(F.col("_kind") == 1)).select(
        "phone", "s_time", "event_id", *row, "_now.*"
    )


def od_lookup(
    signalling: DataFrame,
    roaming: DataFrame,
    level: str,
    line: Timeline = PHONE,
    compat: bool = False,
) -> DataFrame:
    """OD from signalling rows that take place, start and end from the roaming row in force."""
    found = roaming_in_force(local_phone(signalling), roaming, level, line)
    stays = found.where(F.col("r_start").isNotNull()).withColumns(
        {
            "s_time": F.col("r_start"),
            "e_time": F.col("r_end"),
            "code": F.col("cell"),
        }
    )
    merged = S.merge_adjacent_stays(
        stays.drop("r_start", "r_end", "cell"), line, smooth=True, midpoint=False
    )
    changes = od_changes(merged, line, compat=compat)
    return od_table(changes, level, measured=level != "country")


def od_roaming(
    signalling: DataFrame,
    roaming: DataFrame,
    level: str,
    line: Timeline = PHONE,
    compat: bool = False,
) -> DataFrame:
    """OD from the roaming rows of phones that have signalling.

    After smoothing, a roaming row gets the cell, position and home province of the phone's
    latest signalling row in the minute the roaming row ends; without one they stay NULL.
    """
    heard = local_phone(signalling)
    places = _roaming_places(roaming, level)
    stays = S.smooth_overlaps(
        places.join(heard.select("phone"), "phone", "left_semi").select(
            "phone", "date", "event_id", "s_time", "e_time",
            "place_code", "place_name", "place_scene",
        ),
        line,
    )
    minute = F.floor(F.col("s_time") / F.lit(MINUTE_MS))
    latest = heard.groupBy("phone", minute.alias("_minute")).agg(
        F.max_by(
            F.struct("imsi", "home_province", "cell", "lon", "lat"),
            F.struct("s_time", "event_id"),
        ).alias("_at")
    )
    located = stays.withColumn("_minute", F.floor(F.col("e_time") / F.lit(MINUTE_MS))).join(
        latest, ["phone", "_minute"], "left"
    )
    located = located.select(
        *stays.columns,
        F.col("_at.imsi").alias("imsi"),
        F.col("_at.home_province").alias("home_province"),
        F.col("_at.cell").alias("cell"),
        F.col("_at.lon").alias("lon"),
        F.col("_at.lat").alias("lat"),
    )
    # Neighbours at one known cell and place are one stay; unlocated rows stay apart.
    unit = F.concat_ws(
        "|", F.coalesce(F.col("cell"), F.concat(F.lit("row "), "event_id")), "place_code"
    )
    merged = S.merge_adjacent_stays(
        located.withColumn("_unit", unit), line, code="_unit", midpoint=False
    ).withColumn("code", F.col("cell"))
    changes = od_changes(merged, line, skip_blank=True, compat=compat, changed_on="place_name")
    return od_table(changes, level, measured=level != "country")


def province_od_signalling(
    signalling: DataFrame,
    roaming: DataFrame,
    line: Timeline = DAILY,
    phone_line: Timeline = PHONE,
) -> DataFrame:
    """OD from cell stays of phones in the roaming file, their province filled from it."""
    heard = local_phone(signalling).join(roaming.select("phone"), "phone", "left_semi")
    points = heard.withColumns(
        {
            "code": F.col("cell"),
            "scene": F.lit(S.ROAD),
            "rat": F.lit(6),
            "source": F.lit(None).cast("string"),
        }
    )
    carried = [c for c in ("phone", "date", "home_province") if c not in line.keys]
    stays = S.stay_aggregate(
        points, line, carried=tuple(carried)
    )
    placed = roaming_in_force(stays, roaming, "province", phone_line).drop("r_start", "r_end")
    return od_table(od_changes(placed, line, skip_blank=True, changed_on="place_code"), "province")
