"""Projection, distance, grid and geohash queries."""

from pyspark.sql import functions as F

from testbed.registry import query
from testbed.sqlviews import merge, project, unproject
from waymarks.functions import geo, geohash
from waymarks.operators import clean
from waymarks.operators.ordered import annotate
from waymarks.operators.stays import merge_adjacent_stays


BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def degrees(df):
    return df.select("event_id", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


def legs(t):
    """Points with their own and the previous point's projected position."""
    return annotate(
        geo.with_metres(t.points()),
        before={"px": F.col("x"), "py": F.col("y")}, line=t.daily())


LEGS = f""", legs AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM {project('pt')}
  WINDOW w AS (PARTITION BY imsi, date ORDER BY s_time, event_id))"""


@query("project_points", f"SELECT event_id, round(x,3) AS x, round(y,3) AS y FROM {project('pt')}")
def _(t):
    metres = geo.with_metres(t.points())
    return metres.select("event_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query(
    "unproject_points",
    f"""SELECT event_id, round(ulon,7) AS lon, round(ulat,7) AS lat
    FROM {unproject(project('pt'), lon='ulon', lat='ulat')}""",
)
def _(t):
    metres = geo.with_metres(t.points()).select("event_id", "x", "y")
    return degrees(geo.with_degrees(metres))


@query(
    "central_meridian",
    "SELECT event_id, CAST((CAST(trunc(lon/6) AS INTEGER)+1)*6-3 AS INTEGER) AS meridian FROM pt",
)
def _(t):
    return t.points().select("event_id", geo.central_meridian("lon").alias("meridian"))


@query(
    "euclid_distance",
    LEGS + " SELECT event_id, round(sqrt(pow(x-px,2)+pow(y-py,2)),3) AS metres FROM legs",
)
def _(t):
    return legs(t).select("event_id", F.round(geo.euclid("x", "y", "px", "py"), 3).alias("metres"))


@query(
    "manhattan_distance",
    LEGS + " SELECT event_id, round(abs(x-px)+abs(y-py),3) AS metres FROM legs",
)
def _(t):
    return legs(t).select(
        "event_id", F.round(geo.manhattan("x", "y", "px", "py"), 3).alias("metres")
    )


@query(
    "centroid",
    f"""SELECT imsi, date, round(ulon,7) AS lon, round(ulat,7) AS lat FROM
    {unproject(f"(SELECT imsi, date, avg(x) AS x, avg(y) AS y FROM {project('pt')} GROUP BY ALL)",
               lon='ulon', lat='ulat')}""",
)
def _(t):
    c = clean.centroid(t.points(), ("imsi", "date"))
    return c.select("imsi", "date", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


WHOLE_DAY = "(SELECT * REPLACE ('all' AS code), s_time AS e_time FROM pt)"


@query(
    "running_midpoint",
    f"""SELECT imsi, date, round(lon,7) AS lon, round(lat,7) AS lat FROM {merge(WHOLE_DAY)}""",
)
def _(t):
    whole_day = t.points().withColumn("code", F.lit("all")).withColumn("e_time", F.col("s_time"))
    merged = merge_adjacent_stays(whole_day, line=t.daily())
    return merged.select(
        "imsi", "date", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat")
    )


@query(
    "grid_assign",
    f"""SELECT event_id, concat(CAST(trunc(x/50) AS INTEGER), '~', CAST(trunc(y/50) AS INTEGER),
    '~0~50') AS grid_code FROM {project('pt')}""",
)
def _(t):
    return clean.grid_assign(t.points()).select("event_id", "grid_code")


@query(
    "grid_assign_xy",
    f"""SELECT event_id, concat(CAST(trunc(x/50) AS INTEGER), '-', CAST(trunc(y/50) AS INTEGER))
    AS grid FROM {project('pt')}""",
)
def _(t):
    return clean.grid_assign_xy(t.points()).select("event_id", "grid")


def _corner(offset: str) -> str:
    cells = f"""(SELECT event_id, (trunc(x/50)+{offset})*50 AS gx, (trunc(y/50)+{offset})*50 AS gy
      FROM {project('pt')})"""
    return f"""SELECT event_id, round(ulon,7) AS lon, round(ulat,7) AS lat
      FROM {unproject(cells, 'gx', 'gy', 'ulon', 'ulat')}"""


@query("grid_to_lonlat", _corner("0"))
def _(t):
    grids = clean.grid_assign_xy(t.points()).select("event_id", "grid")
    return degrees(geo.with_grid_origin(grids))


@query("grid_center", _corner("5e-1"))
def _(t):
    grids = clean.grid_assign(t.points()).select("event_id", "grid_code")
    return degrees(geo.with_grid_center(grids))


@query(
    "grid_indoor_session",
    f"""SELECT event_id, concat(CAST(trunc(gx/50) AS INTEGER), '~', CAST(trunc(gy/50) AS INTEGER),
    '~0~50') AS grid_code FROM (SELECT event_id,
      CASE WHEN first_value(scene) OVER o = 'INDOOR' THEN avg(x) OVER s ELSE x END AS gx,
      CASE WHEN first_value(scene) OVER o = 'INDOOR' THEN avg(y) OVER s ELSE y END AS gy
      FROM {project('pt')} WINDOW s AS (PARTITION BY imsi, date),
      o AS (PARTITION BY imsi, date ORDER BY s_time, event_id))""",
)
def _(t):
    return clean.grid_indoor_session(t.points()).select("event_id", "grid_code")


def _geohash_sql(lon: str, lat: str) -> str:
    """Geohash by bisection: each bit says in which half of the remaining range a value lies."""
    lo, la = (
        f"(CAST(ceil(({v}+{half})/45*pow(2,{p})) AS BIGINT)-1)"
        for v, half, p in ((lon, 180, 27), (lat, 90, 28))
    )
    chars = []
    for i in range(12):
        bits = []
        for j in range(5):
            n = 5 * i + j
            source, at = (lo, 29 - n // 2) if n % 2 == 0 else (la, 29 - n // 2)
            bits.append(f"(({source} >> {at}) & 1) * {16 >> j}")
        chars.append(f"substr('{BASE32}', CAST({' + '.join(bits)} AS BIGINT) + 1, 1)")
    return "concat(" + ", ".join(chars) + ")"


GEOHASH = _geohash_sql("lon", "lat")


@query("geohash_encode", f"SELECT event_id, {GEOHASH} AS geohash FROM pt")
def _(t):
    return t.points().select(
        "event_id", geohash.encode(F.col("lon"), F.col("lat")).alias("geohash")
    )


@query(
    "geohash_decode",
    f""", g AS (SELECT event_id, {GEOHASH} AS h FROM pt),
    d AS (SELECT event_id, h, list_transform(range(0, 60), lambda n:
        ((instr('{BASE32}', substr(h, n//5 + 1, 1)) - 1) >> (4 - n%5)) & 1) AS b FROM g),
    f AS (SELECT event_id, h,
      list_sum(list_transform(range(0, 30), lambda i: b[2*i+1] * pow(2, -(i+1)))) AS fx,
      list_sum(list_transform(range(0, 30), lambda i: b[2*i+2] * pow(2, -(i+1)))) AS fy FROM d),
    e AS (SELECT event_id, h, -180 + 360*fx + 180*pow(2,-30) AS lon,
      -90 + 180*fy + 90*pow(2,-30) AS lat FROM f)
    SELECT event_id, h AS geohash, round(lat - fmod(lat, 1e-6), 7) AS lat,
      round(lon - fmod(lon, 1e-6), 7) AS lon, 90*pow(2,-30) AS lat_err, 180*pow(2,-30) AS lon_err
    FROM e""",
)
def _(t):
    coded = t.points().select(
        "event_id", geohash.encode(F.col("lon"), F.col("lat")).alias("geohash")
    )
    lat, lon, lat_err, lon_err = geohash.decode(F.col("geohash"))
    return coded.withColumns({"lat_err": lat_err, "lon_err": lon_err}).select(
        "event_id",
        "geohash",
        F.round(geohash.trim_to_error(lat, F.col("lat_err")), 7).alias("lat"),
        F.round(geohash.trim_to_error(lon, F.col("lon_err")), 7).alias("lon"),
        "lat_err",
        "lon_err",
    )


@query("cell_site_geohash", f"SELECT eci, {GEOHASH} AS geohash FROM cells")
def _(t):
    return t.cells().select("eci", geohash.encode(F.col("lon"), F.col("lat")).alias("geohash"))


@query(
    "cells_within_radius",
    f"""SELECT eci, round(distance,3) AS distance FROM (SELECT c.eci,
      sqrt(pow(c.x-p.x,2)+pow(c.y-p.y,2)) AS distance FROM {project('cells')} c,
      {project("(SELECT 10507e-2 AS lon, 2655e-2 AS lat)")} p) WHERE distance < 5000""",
)
def _(t):
    near = clean.cells_within_radius(t.cells(), 105.07, 26.55, 5000)
    return near.select("eci", F.round("distance", 3).alias("distance"))


@query(
    "cell_set_contains",
    """SELECT event_id, eci FROM pt WHERE eci IN (SELECT eci FROM cells WHERE scene_id='YDY3')""",
)
def _(t):
    chosen = t.cells().where(F.col("scene_id") == "YDY3")
    return clean.keep_cells_in_dim(t.points(), chosen, "eci").select("event_id", "eci")


@query(
    "cells_near_places",
    f""", near AS (SELECT DISTINCT lon, lat, 'p' || k AS place FROM cells WHERE k%100=7)
    SELECT place, eci, round(distance,3) AS distance FROM (SELECT p.place, c.eci,
      sqrt(pow(c.x-p.x,2)+pow(c.y-p.y,2)) AS distance
      FROM {project('cells')} c, {project('near')} p) WHERE distance < 3000""",
)
def _(t):
    places = t.cells().where(F.col("k") % 100 == 7).select(
        F.concat(F.lit("p"), "k").alias("place"), "lon", "lat"
    )
    near = clean.cells_near_places(t.cells(), places, 3000)
    return near.select("place", "eci", F.round("distance", 3).alias("distance"))
