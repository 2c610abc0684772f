"""Trips between transport hubs."""

from pyspark.sql import functions as F

from testbed.registry import query
from testbed.sqlviews import merge, project, runs, smooth
from waymarks.operators import trips as R

ORDER = "s_time, event_id"


@query(
    "rail_trip_first_pair",
    f""", hb AS (SELECT iv.* REPLACE (coalesce(c.hub, '') AS code) FROM iv LEFT JOIN
      (SELECT code, concat(scene_name, county_id) AS hub FROM cells
        WHERE scene_id IN ('YDY2','YDY3') AND code<>'0') c USING (code)),
    m AS (SELECT * FROM {merge('hb')} WHERE code<>''),
    o AS (SELECT imsi, date, arg_min(code, ({ORDER})) AS o_code, arg_min(e_time, ({ORDER})) AS o_e,
      arg_min(lon, ({ORDER})) AS o_lon, arg_min(lat, ({ORDER})) AS o_lat FROM m GROUP BY ALL),
    d AS (SELECT m.imsi, m.date, o_code, o_e, o_lon, o_lat, arg_min(code, ({ORDER})) AS code,
      min(s_time) AS d_s, arg_min(lon, ({ORDER})) AS lon, arg_min(lat, ({ORDER})) AS lat
      FROM m JOIN o USING (imsi, date) WHERE code<>o_code GROUP BY ALL)
    SELECT imsi, date, o_e AS depart_time, o_code AS start_hub, code AS end_hub, '高铁' AS mode,
      round(sqrt(pow(x-ox,2)+pow(y-oy,2)),3) AS mileage, d_s-o_e AS duration
    FROM {project(project('d'), 'o_lon', 'o_lat', 'ox', 'oy')} WHERE d_s<>o_e""",
)
def _(t):
    hubs = t.hubs().select("code", "rat", F.concat("scene_name", "county_id").alias("area_code"))
    trips = R.rail_trip_first_pair(t.intervals(), hubs, line=t.daily())
    return trips.withColumn("mileage", F.round("mileage", 3))


def hub_sql(join: str) -> str:
    return f""", hb AS (SELECT iv.*, coalesce(scene_name, '') AS hub FROM iv {join}
      (SELECT code, rat, scene_name FROM cells WHERE scene_id IN ('YDY2','YDY3') AND code<>'0') c USING (code, rat))"""


SEGMENTS = (
    hub_sql("JOIN")
    + f""", m AS (SELECT * FROM {merge(smooth('hb'), carry=('hub',))}),
    g AS (SELECT imsi, date, hub, arg_min(code, ({ORDER})) AS a_code, arg_min(e_time, ({ORDER})) AS a_e,
        arg_min(lon, ({ORDER})) AS a_lon, arg_min(lat, ({ORDER})) AS a_lat,
        arg_max(code, ({ORDER})) AS b_code, arg_max(s_time, ({ORDER})) AS b_s,
        arg_max(lon, ({ORDER})) AS b_lon, arg_max(lat, ({ORDER})) AS b_lat
      FROM {runs('m', 'hub')} GROUP BY imsi, date, hub, g),
    p AS (SELECT *, sqrt(pow(bx-ax,2)+pow(by_-ay,2))/1000 AS km, floor((b_s-a_e)/1000) AS sec
      FROM {project(project('g', 'a_lon', 'a_lat', 'ax', 'ay'), 'b_lon', 'b_lat', 'bx', 'by_')})
    SELECT imsi, date, a_code AS start_transportation, b_code AS end_transportation,
      substr(hub,1,2) AS trans_type, round(km,6) AS mileage,
      sign(sec)*((abs(CAST(sec AS BIGINT))+18)//36)/1e2 AS duration FROM p WHERE km>20 OR sec>600"""
)


@query("hub_trip_segments", SEGMENTS)
def _(t):
    return R.hub_trip_segments(t.intervals(), t.hubs(), line=t.daily())


BY_END = "e_time, s_time, event_id"
CHANGES = (
    hub_sql("LEFT JOIN")
    + f""", m AS (SELECT * FROM {project(merge('hb', order=BY_END, carry=('hub',)))}),
    q AS (SELECT *, lag(hub) OVER w AS p_hub, lag(code) OVER w AS p_code, lag(e_time) OVER w AS p_e,
        lag(x) OVER w AS px, lag(y) OVER w AS py, row_number() OVER w AS rn,
        count(*) OVER (PARTITION BY imsi, date) AS n FROM m
      WINDOW w AS (PARTITION BY imsi, date ORDER BY {ORDER})),
    v AS (SELECT *, hub <> coalesce(p_hub,'') AS turn, sqrt(pow(x-px,2)+pow(y-py,2)) AS dist FROM q)"""
)


@query(
    "hub_trip_changes",
    CHANGES
    + """ SELECT imsi, date, s_time AS depart_time, code AS start_hub, p_code AS end_hub, hub AS mode,
    round(dist,3) AS mileage, s_time-p_e AS duration FROM v WHERE turn AND rn>1""",
)
def _(t):
    return R.hub_trip_changes(t.intervals(), t.hubs(), line=t.daily()).withColumn("mileage", F.round("mileage", 3))


def kept(value: str) -> str:
    return f"""last_value(CASE WHEN turn AND rn>2 AND rn<n THEN {value} END IGNORE NULLS) OVER
      (PARTITION BY imsi, date ORDER BY {ORDER})"""


@query(
    "hub_trip_changes_compat",
    CHANGES
    + f""" SELECT * EXCLUDE (turn) FROM (SELECT imsi, date, s_time AS depart_time, code AS start_hub,
      coalesce({kept('p_code')}, '') AS end_hub, hub AS mode, turn,
      round(coalesce({kept('dist')}, 0), 3) AS mileage,
      CAST(coalesce({kept('p_e-s_time')}, 0) AS BIGINT) AS duration FROM v) WHERE turn""",
)
def _(t):
    trips = R.hub_trip_changes(t.intervals(), t.hubs(), compat=True, line=t.daily())
    return trips.withColumn("mileage", F.round("mileage", 3))


@query(
    "hub_trips_published",
    SEGMENTS.replace("SELECT imsi, date, a_code", ", tp AS (SELECT imsi, date, a_code")
    + """) SELECT date AS "timeStamp", imsi, coalesce(phone, '') AS phone, coalesce(imei, '') AS imei,
      start_transportation, end_transportation, trans_type, mileage, duration
    FROM tp LEFT JOIN subs USING (imsi)""",
)
def _(t):
    trips = R.hub_trip_segments(t.intervals(), t.hubs(), line=t.daily())
    return R.published_trips(trips, t.subscribers())
