"""End-to-end jobs."""

from pyspark.sql import functions as F

from testbed.queries.geometry import GEOHASH
from testbed.queries.cleaning import VOICE
from testbed.registry import query
from testbed.sqlviews import aggregate, merge, project, runs, smooth, unproject
from waymarks.functions.calendar import UTC
from waymarks.operators import stays as S
from waymarks.operators.ordered import Timeline
from waymarks.plans import jobs as J

ORDER = "s_time, event_id"


def degrees(df, lon="longitude", lat="latitude"):
    return df.withColumns({lon: F.round(lon, 7), lat: F.round(lat, 7)})


def cell_table(points: str) -> str:
    hashed = GEOHASH.replace("(lon+", "(a.lon+").replace("(lat+", "(a.lat+")
    return f""" SELECT a.imsi, a.date, '' AS msisdn, '' AS imei, a.code AS lac_cell, a.rat,
      round(a.lon,7) AS longitude, round(a.lat,7) AS latitude, {hashed} AS geohash,
      'CN' AS country_code, coalesce(city_id,'') AS city_code, coalesce(county_id,'') AS county_code,
      a.s_time AS enter_time, a.e_time AS leave_time, source
    FROM {aggregate(points)} a LEFT JOIN cells c ON a.code=c.code AND a.rat=c.rat AND c.code<>'0'"""


CELL_TABLE = "SELECT * FROM ("


@query("cell_stay_table", CELL_TABLE + cell_table("pt") + ")")
def _(t):
    return degrees(J.cell_stay_table(t.points(), t.cells(), line=t.daily()))


PING = """, pp AS (SELECT * REPLACE (CASE WHEN lag(code) OVER w = lead(code) OVER w THEN lag(code) OVER w
    ELSE code END AS code) FROM pt WINDOW w AS (PARTITION BY imsi, date ORDER BY s_time, event_id))"""


@query("cell_stay_table_ping_pong", PING + CELL_TABLE.replace("SELECT", " SELECT", 1) + cell_table("pp") + ")")
def _(t):
    return degrees(J.cell_stay_table(t.points(), t.cells(), ping_pong=True, line=t.daily()))


BY_END = "e_time, s_time, event_id"


@query(
    "cell_stay_table_text",
    f""", sb AS (SELECT iv_eci.*, concat('138', imsi) AS phone, concat('86', imsi) AS imei FROM iv_eci),
    m AS (SELECT * FROM {merge('sb', keys='phone, imsi, imei, date', order=BY_END)})
    SELECT imsi, phone, imei, date, m.code AS cell, round(m.lon,7) AS longitude,
      round(m.lat,7) AS latitude, {GEOHASH.replace('(lon+', '(m.lon+').replace('(lat+', '(m.lat+')}
      AS geohash, 'CHN' AS country_code, coalesce(county_id,'') AS county_code, s_time AS enter_time,
      e_time AS leave_time
    FROM m LEFT JOIN (SELECT CAST(eci AS VARCHAR) AS ec, county_id FROM cells) c ON m.code=c.ec""",
)
def _(t):
    who = {"phone": F.concat(F.lit("138"), "imsi"), "imei": F.concat(F.lit("86"), "imsi")}
    rows = t.intervals("eci").withColumns(who).withColumn("eci", F.col("code").cast("bigint"))
    counties = t.cells().select(F.col("eci").cast("string").alias("code"), "county_id")
    return degrees(
        J.cell_stay_table_text(rows.drop("lon", "lat", "code"), t.cells(), counties, J.IDENTITY)
    )


GRID_XY = "concat(CAST(trunc(x/50) AS INTEGER), '-', CAST(trunc(y/50) AS INTEGER))"
GRID_HOUR = f""", gp AS (SELECT * EXCLUDE (x, y) REPLACE ({GRID_XY} AS code),
      strftime(make_timestamp(s_time*1000), '%H') AS hour_id, date AS day_id
    FROM {project("(SELECT * FROM pt WHERE loc_type IN ('5','6'))")}),
  gs AS (SELECT imsi, day_id, hour_id, code, arg_min(event_id, ({ORDER})) AS event_id,
      min(s_time) AS s_time, max(s_time) AS e_time
    FROM {runs('gp', keys='imsi, day_id, hour_id')} GROUP BY imsi, day_id, hour_id, code, g),
  gc AS (SELECT imsi, day_id, hour_id, code, array_to_string(list(eci ORDER BY f), '#') AS ecis
    FROM (SELECT imsi, day_id, hour_id, code, eci, min((s_time, event_id)) AS f FROM gp GROUP BY ALL)
    GROUP BY ALL),
  gt AS (SELECT gs.*, ecis FROM gs JOIN gc USING (imsi, day_id, hour_id, code))"""


def grid_rows(source: str, extra: str) -> str:
    corner = unproject(
        f"""(SELECT *, CAST(split_part(code,'-',1) AS DOUBLE)*50 AS gx,
        CAST(split_part(code,'-',2) AS DOUBLE)*50 AS gy FROM {source})""",
        "gx", "gy", "_glon", "_glat",
    )
    return f"""SELECT '' AS calling_no, code AS grid, '' AS calling_imei, imsi AS calling_imsi,
      round(_glon,7) AS lon, round(_glat,7) AS lat,
      strftime(make_timestamp(s_time*1000), '%Y-%m-%d %H:%M:%S') AS start_time,
      (e_time-s_time)//1000 AS stay_time,
      strftime(make_timestamp(e_time*1000), '%Y-%m-%d %H:%M:%S') AS end_time, ecis, 'MR' AS source,
      event_id, s_time, e_time, {extra} FROM {corner}"""


def hour_points(t):
    p = t.points().withColumn("day_id", F.col("date"))
    hour = F.lpad(UTC.hour(F.col("s_time")).cast("string"), 2, "0")
    return p.withColumn("hour_id", hour)


def grid_hours(t):
    points = hour_points(t)
    return J.grid_trace_hour(points, J.GRID_HOUR, clock=UTC)


@query("grid_trace_hour", GRID_HOUR + " " + grid_rows("gt", "day_id, hour_id"))
def _(t):
    return degrees(grid_hours(t), "lon", "lat")


GRID_DAY = "imsi, day_id"


@query(
    "grid_trace_day",
    GRID_HOUR
    + f""", gl AS (SELECT *, 0e0 AS lon, 0e0 AS lat, 'ROAD' AS scene, 6 AS rat FROM gt),
    gd AS (SELECT * EXCLUDE (lon, lat) FROM {merge(smooth('gl', GRID_DAY), GRID_DAY, carry=('ecis',),
                                                    midpoint=False)}) """
    + grid_rows("gd", "day_id"),
)
def _(t):
    hourly = grid_hours(t)
    return degrees(J.grid_trace_day(hourly, clock=UTC, line=J.GRID_DAY), "lon", "lat")


TICKETS = f""", tk AS (SELECT event_id, imsi, phone, strftime(make_timestamp(s_time*1000), '%Y-%m-%d') AS date,
      CASE WHEN service='voice' THEN {VOICE} ELSE CAST(lac*256 + ci AS VARCHAR) END AS code,
      s_time, s_time + seconds*1000 AS e_time, city_code, county_code, 0e0 AS lon, 0e0 AS lat,
      'ROAD' AS scene, 0 AS rat FROM tick)"""
TICKET_KEYS = "imsi, phone, date"


def ticket_tables(t):
    tickets = t.tickets()
    return [
        tickets.where((F.col("origin") == o) & (F.col("service") == s))
        for o in ("local", "out")
        for s in ("voice", "data")
    ]


@query(
    "ticket_trace",
    TICKETS
    + f""" SELECT imsi, date, phone AS msisdn, '' AS imei, code AS lac_cell, '86' AS country_code,
      city_code, county_code, s_time AS enter_time, e_time AS leave_time, 'bill' AS source
    FROM {merge(smooth('tk', TICKET_KEYS), TICKET_KEYS, carry=('city_code', 'county_code'),
                midpoint=False)}""",
)
def _(t):
    return J.ticket_trace(*ticket_tables(t), clock=UTC, line=t.by_ticket())


@query(
    "merge_ticket_and_location",
    TICKETS
    + f""", b AS (SELECT imsi, date, event_id, code, s_time, e_time, CAST(NULL AS DOUBLE) AS lon,
      CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS VARCHAR) AS scene, 0 AS rat, 'bill' AS source
      FROM {merge(smooth('tk', TICKET_KEYS), TICKET_KEYS, midpoint=False)}),
    a AS (SELECT imsi, date, event_id, code, s_time, e_time, lon, lat, scene, rat, 'xdr' AS source FROM iv),
    u AS (SELECT * FROM a UNION ALL SELECT * FROM b),
    m AS (SELECT * FROM {merge(smooth('u'), carry=('source',))})
    SELECT imsi, date, event_id, code, s_time, e_time, duration, scene, source, round(lon,7) AS lon,
      round(lat,7) AS lat, CASE WHEN lon IS NULL THEN '' ELSE {GEOHASH} END AS geohash FROM m""",
)
def _(t):
    located = t.intervals().withColumn("source", F.lit("xdr")).drop("rat")
    tickets = J.merged_tickets(*ticket_tables(t), clock=UTC, line=t.by_ticket()).select(
        "imsi", "date", "event_id", "code", "s_time", "e_time", F.lit("bill").alias("source")
    )
    return degrees(J.merge_ticket_and_location(tickets, located, t.daily()), "lon", "lat")


STAY_TEXT = """concat_ws(',', CAST(lon AS VARCHAR), CAST(lat AS VARCHAR), '', code, s_time, e_time,
    duration, CASE WHEN scene='INDOOR' THEN 'INDOOR' ELSE 'ROAD' END)"""


@query(
    "trace_serialise",
    f""", m AS (SELECT * FROM {merge('iv', midpoint=False)})
    SELECT imsi, date, s_time//3600000 AS part, concat(imsi, ',SECTOR#',
      array_to_string(list({STAY_TEXT} ORDER BY {ORDER}), '#')) AS trace FROM m GROUP BY imsi, date, part""",
)
def _(t):
    stays = S.merge_adjacent_stays(t.intervals(), midpoint=False, line=t.daily())
    return S.trace_serialise(stays, line=t.daily())


@query(
    "point_trace_text",
    f""", m AS (SELECT * FROM {aggregate('pt')})
    SELECT imsi, date, s_time//3600000 AS part, concat(imsi, ',SECTOR#', array_to_string(list(
      concat_ws(',', 'lonlat', '', code, s_time, CASE WHEN e_time<>0 THEN e_time END, duration,
        CASE WHEN scene='INDOOR' THEN 'INDOOR' ELSE 'ROAD' END) ORDER BY {ORDER}), '#')) AS trace,
      list(round(lon, 6) ORDER BY {ORDER}) AS lons, list(round(lat, 6) ORDER BY {ORDER}) AS lats
    FROM m GROUP BY imsi, date, part""",
)
def _(t):
    """Whole texts; the positions in them are compared as numbers."""
    texts = J.point_trace_text(t.points(), line=t.daily())
    stays = F.slice(F.split("trace", "#"), 2, 10**6)

    def number(i):
        return F.transform(stays, lambda s: F.round(F.split(s, ",")[i].cast("double"), 6))

    rest = F.regexp_replace("trace", "#[-0-9.E]*,[-0-9.E]*,", "#lonlat,")
    return texts.select(
        "imsi", "date", "part", rest.alias("trace"), number(0).alias("lons"), number(1).alias("lats")
    )


@query(
    "interval_trace_count",
    f""", ph AS (SELECT *, concat('138', imsi) AS phone FROM iv_eci
      WHERE code IN (SELECT CAST(eci AS VARCHAR) FROM cells WHERE k%7<>0))
    SELECT phone, date, count(*) AS stays FROM {merge('ph', 'phone, date', BY_END, midpoint=False)}
    GROUP BY ALL""",
)
def _(t):
    rows = t.intervals("eci").withColumn("phone", F.concat(F.lit("138"), "imsi"))
    rows = rows.withColumn("eci", F.col("code").cast("bigint"))
    return J.interval_trace_count(rows, t.cells().where(F.col("k") % 7 != 0))


@query(
    "stay_count_per_trace",
    f"SELECT imsi, date, count(*) AS stays FROM {merge('iv_city', midpoint=False)} GROUP BY ALL",
)
def _(t):
    return S.stay_count_per_trace(S.merge_adjacent_stays(t.intervals("city"), midpoint=False, line=t.daily()))


@query(
    "single_area_subscribers",
    f""", rl AS (SELECT iv.* REPLACE (coalesce(c.county_id,'') AS code) FROM iv LEFT JOIN
      (SELECT * FROM cells WHERE scene_id<>'YDY2' AND code<>'0') c ON iv.code=c.code AND iv.rat=c.rat),
    m AS (SELECT *, count(*) OVER (PARTITION BY imsi, date) AS n FROM {merge('rl', midpoint=False)})
    SELECT imsi, date, code AS area_code, s_time, e_time FROM m WHERE n=1""",
)
def _(t):
    area = t.cells().where(F.col("scene_id") != "YDY2").select(
        "code", F.col("county_id").alias("area_code")
    )
    return J.single_area_subscribers(t.intervals(), area)


@query(
    "secondary_sort",
    """SELECT o_orderpriority AS grade, o_orderkey AS student,
    CAST(CASE WHEN o_orderkey%9=0 THEN 0 ELSE o_orderkey%100 END AS INTEGER) AS score
    FROM orders ORDER BY grade, score DESC, student""",
)
def _(t):
    o = F.col("o_orderkey")
    rows = t.raw("orders").select(
        F.col("o_orderpriority").alias("grade"),
        o.alias("student"),
        F.when(o % 9 == 0, "absent").otherwise((o % 100).cast("string")).alias("score"),
    )
    return J.secondary_sort(rows, "grade", "score", ("student",))


@query(
    "smooth_overlaps_day",
    f"SELECT * FROM {smooth('iv')} WHERE (imsi, date) IN (SELECT (imsi, date) FROM iv GROUP BY imsi, date HAVING count(*)>1)",
)
def _(t):
    return S.smooth_overlaps(t.intervals(), drop_single=True, line=t.daily())


@query("suppress_ping_pong", PING.replace("FROM pt", "FROM iv_county") + " SELECT event_id, code FROM pp")
def _(t):
    return S.suppress_ping_pong(t.intervals("county"), line=t.daily()).select("event_id", "code")


@query(
    "validate_stay_order",
    f"""SELECT imsi, date, event_id, s_time, previous_end FROM (SELECT *, lag(e_time) OVER
      (PARTITION BY imsi, date ORDER BY {ORDER}) AS previous_end FROM iv) WHERE previous_end > s_time""",
)
def _(t):
    bad = S.validate_stay_order(t.intervals(), line=t.daily())
    return bad.select("imsi", "date", "event_id", "s_time", "previous_end")


@query(
    "cells_per_grid",
    f""", gp AS (SELECT *, {GRID_XY} AS grid FROM {project('pt')})
    SELECT imsi, date, grid, array_to_string(list(eci ORDER BY f), '#') AS ecis FROM
      (SELECT imsi, date, grid, eci, min((s_time, event_id)) AS f FROM gp GROUP BY ALL) GROUP BY ALL""",
)
def _(t):
    from waymarks.operators.clean import grid_assign_xy

    return S.cells_per_grid(grid_assign_xy(t.points()))


@query(
    "relabel_and_remerge",
    f""", rl AS (SELECT iv.* REPLACE (coalesce(c.county_id, iv.code) AS code) FROM iv LEFT JOIN
      (SELECT * FROM cells WHERE scene_id<>'YDY2' AND code<>'0') c ON iv.code=c.code)
    SELECT imsi, date, event_id, code, s_time, e_time, duration, round(lon,7) AS lon, round(lat,7) AS lat,
      scene, rat FROM {merge('rl')}""",
)
def _(t):
    area = t.cells().where(F.col("scene_id") != "YDY2").select(
        "code", F.col("county_id").alias("area_code")
    )
    merged = S.relabel_and_remerge(t.intervals(), area, unknown=None, line=t.daily())
    return degrees(merged, "lon", "lat")


APPENDED = f""", sp AS (SELECT imsi, date, min(s_time) AS f, max(e_time) AS t FROM iv_county GROUP BY ALL),
    fold AS (SELECT imsi, list_reduce(list({{'f': f, 't': t, 'd': [date]}} ORDER BY f, t, date), lambda a, b:
      CASE WHEN b.f > a.t OR b.t < a.f
      THEN {{'f': least(a.f, b.f), 't': greatest(a.t, b.t), 'd': list_concat(a.d, b.d)}} ELSE a END) AS x
      FROM sp GROUP BY imsi),
    kept AS (SELECT imsi, unnest(x.d) AS date FROM fold),
    marked AS (SELECT *, CASE WHEN date <> lag(date) OVER w AND code = lag(code) OVER w THEN 0 ELSE 1 END AS n
      FROM iv_county SEMI JOIN kept USING (imsi, date)
      WINDOW w AS (PARTITION BY imsi ORDER BY {ORDER})),
    numbered AS (SELECT *, sum(n) OVER (PARTITION BY imsi ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING) AS g
      FROM {project('marked', x='_x', y='_y')}),
    joined AS (SELECT imsi, arg_min(event_id, ({ORDER})) AS event_id, arg_min(date, ({ORDER})) AS date,
      arg_min(code, ({ORDER})) AS code, min(s_time) AS s_time, max(e_time) AS e_time,
      max(e_time) - min(s_time) AS duration, arg_min(rat, ({ORDER})) AS rat, count(*) AS cnt,
      CASE WHEN bool_or(scene='INDOOR') THEN 'INDOOR' ELSE arg_max(scene, ({ORDER})) END AS scene,
      arg_min(lon, ({ORDER})) AS lon1, arg_min(lat, ({ORDER})) AS lat1,
      list_reduce(list(_x ORDER BY {ORDER}), lambda p, q: (p+q)/2) AS _mx,
      list_reduce(list(_y ORDER BY {ORDER}), lambda p, q: (p+q)/2) AS _my FROM numbered GROUP BY imsi, g)"""


@query(
    "merge_traces_across_days",
    APPENDED
    + f""" SELECT imsi, event_id, date, code, s_time, e_time, duration, scene, rat,
      round(CASE WHEN cnt=1 THEN lon1 ELSE _ulon END, 7) AS lon,
      round(CASE WHEN cnt=1 THEN lat1 ELSE _ulat END, 7) AS lat
    FROM {unproject('joined', '_mx', '_my', '_ulon', '_ulat')}""",
)
def _(t):
    return degrees(S.append_traces(t.intervals("county"), "date", t.lifetime()), "lon", "lat")


@query(
    "trace_is_on_road",
    "SELECT imsi, date, NOT bool_or(scene='INDOOR') AS on_road FROM iv GROUP BY ALL",
)
def _(t):
    return S.traces_on_road(t.intervals())


@query(
    "trace_is_empty",
    """SELECT DISTINCT imsi, date FROM iv WHERE (imsi, date) NOT IN
    (SELECT (imsi, date) FROM iv WHERE scene='INDOOR')""",
)
def _(t):
    stays = t.intervals()
    return S.empty_traces(stays, stays.where(F.col("scene") == "INDOOR"))
