"""Questions about traces, asked of county-level traces."""

from pyspark.sql import functions as F

from testbed.registry import query
from testbed.sqlviews import MIDNIGHT, TRACE, project
from waymarks.functions.calendar import HOUR_MS, UTC
from waymarks.operators import traces as E

ORDER = "s_time, event_id"


def hours(h):
    return UTC.day_ms(F.col("date")) + h * HOUR_MS


IN_WORK = f"s_time >= {MIDNIGHT} + 28800000 AND e_time <= {MIDNIGHT} + 61200000"


def passage_sql(origin: str, destination: str, source: str = "tr") -> str:
    """Destination stays whose last end-point stay before is an origin stay."""
    cols = ("event_id", "code", "s_time", "e_time", "lon", "lat")
    lags = ", ".join(f"lag({c}) OVER w AS o_{c}" for c in cols)
    return f"""(SELECT * FROM (SELECT *, {lags} FROM {source} WHERE code IN ({origin}, {destination})
      WINDOW w AS (PARTITION BY imsi, date ORDER BY {ORDER}))
      WHERE code = {destination} AND {origin} <> {destination} AND o_code = {origin})"""


@query("trace_contains", TRACE + " SELECT imsi, date, bool_or(code='C3') AS visited FROM tr GROUP BY ALL")
def _(t):
    return E.trace_contains(t.trace(), "C3")


@query(
    "trace_passby_count",
    """SELECT imsi, date, c.code AS place, count(*) AS passes FROM iv JOIN cells c
    ON iv.lon=c.lon AND iv.lat=c.lat WHERE c.scene_id='YDY3' GROUP BY ALL""",
)
def _(t):
    places = t.cells().where(F.col("scene_id") == "YDY3").withColumn("place", F.col("code"))
    return E.trace_passby_count(t.intervals(), places)


@query(
    "total_time_by_code",
    TRACE + " SELECT imsi, date, code, CAST(sum(duration) AS BIGINT) AS total_ms FROM tr GROUP BY ALL",
)
def _(t):
    return E.total_time_by_code(t.trace())


@query(
    "total_time_by_coord",
    """SELECT imsi, date, c.code AS place, CAST(sum(duration) AS BIGINT) AS total_ms FROM iv
    JOIN cells c ON iv.lon=c.lon AND iv.lat=c.lat WHERE c.scene_id='YDY3' GROUP BY ALL""",
)
def _(t):
    places = t.cells().where(F.col("scene_id") == "YDY3").withColumn("place", F.col("code"))
    return E.total_time_by_coord(t.intervals(), places)


@query(
    "sub_trace_by_time",
    TRACE + f" SELECT imsi, date, event_id, code, s_time, e_time FROM tr WHERE {IN_WORK}",
)
def _(t):
    sub = E.sub_trace_by_time(t.trace(), hours(8), hours(17))
    return sub.select("imsi", "date", "event_id", "code", "s_time", "e_time")


@query("stays_at_code", TRACE + " SELECT imsi, date, event_id, s_time, e_time FROM tr WHERE code='C3'")
def _(t):
    return E.stays_at_code(t.trace(), "C3").select("imsi", "date", "event_id", "s_time", "e_time")


@query(
    "sub_traces_between",
    TRACE
    + f""", p AS {passage_sql("'C1'", "'C2'")}
    SELECT tr.imsi, tr.date, p.o_event_id AS passage, tr.event_id, tr.code FROM tr JOIN p
    ON tr.imsi=p.imsi AND tr.date=p.date AND (tr.s_time, tr.event_id) >= (p.o_s_time, p.o_event_id)
      AND (tr.s_time, tr.event_id) <= (p.s_time, p.event_id)""",
)
def _(t):
    sub = E.sub_traces_between(t.trace(), F.lit("C1"), F.lit("C2"), line=t.daily())
    return sub.select(
        "imsi", "date", F.col("passage.event_id").alias("passage"), "event_id", "code"
    )


def length_sql(source: str) -> str:
    return f"""SELECT imsi, date, round(coalesce(sum(sqrt(pow(x-px,2)+pow(y-py,2))),0),3) AS distance,
      round(coalesce(sum(abs(x-px)+abs(y-py)),0),3) AS manhattan_distance
    FROM (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM {project(source)}
      WINDOW w AS (PARTITION BY imsi, date ORDER BY {ORDER})) GROUP BY ALL"""


def rounded(df):
    return df.withColumns(
        {
            "distance": F.round("distance", 3),
            "manhattan_distance": F.round("manhattan_distance", 3),
        }
    )


@query("path_length", TRACE + " " + length_sql("tr"))
def _(t):
    return rounded(E.path_length(t.trace(), line=t.daily()))


@query(
    "path_length_in_window",
    TRACE + f", w AS (SELECT * FROM tr WHERE {IN_WORK}) " + length_sql("w"),
)
def _(t):
    return rounded(E.path_length_in_window(t.trace(), hours(8), hours(17), line=t.daily()))


@query(
    "trace_cost_time",
    TRACE
    + """ SELECT imsi, date, arg_max(s_time, (s_time, event_id)) - arg_min(e_time, (s_time, event_id))
    AS cost_ms FROM tr GROUP BY ALL""",
)
def _(t):
    return E.trace_cost_time(t.trace())


@query(
    "od_mean_cost_time",
    TRACE
    + f""" SELECT imsi, date, count(*) AS passages, CAST(sum(s_time-o_e_time)//count(*) AS BIGINT)
    AS mean_ms FROM {passage_sql("'C1'", "'C2'")} GROUP BY ALL HAVING sum(s_time-o_e_time)>0""",
)
def _(t):
    return E.od_mean_cost_time(t.trace(), "C1", "C2", line=t.daily())


HW = (
    TRACE
    + f""", hw AS (SELECT tr.*, live_aoi AS home, work_aoi AS office FROM tr JOIN subs USING (imsi)),
  legs AS (SELECT *, 'home_to_work' AS direction FROM {passage_sql("home", "office", "hw")}
    UNION ALL SELECT *, 'work_to_home' FROM {passage_sql("office", "home", "hw")})"""
)


@query(
    "home_work_passages",
    HW
    + """ SELECT imsi, date, direction, o_event_id, event_id AS d_event_id, o_code,
    code AS d_code FROM legs""",
)
def _(t):
    legs = E.home_work_passages(t.trace(), t.subscribers(), line=t.daily())
    return legs.select(
        "imsi",
        "date",
        "direction",
        F.col("o.event_id").alias("o_event_id"),
        F.col("d.event_id").alias("d_event_id"),
        F.col("o.code").alias("o_code"),
        F.col("d.code").alias("d_code"),
    )


@query(
    "commute_times",
    HW
    + """ SELECT imsi, date, direction, o_event_id AS event_id, s_time-o_e_time AS commute_ms
    FROM legs""",
)
def _(t):
    return E.commute_times(t.trace(), t.subscribers(), line=t.daily())


MEDIANS = ", med AS (SELECT imsi, direction, median(s_time-o_e_time) AS median_ms FROM legs GROUP BY ALL)"


@query("commute_median", HW + MEDIANS + " SELECT * FROM med")
def _(t):
    return E.commute_median(t.trace(), t.subscribers(), line=t.daily())


def dwell_sql(source: str) -> str:
    """Longest dwell away from home per trace, if over an hour; ties go to the smallest code."""
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY imsi, date
        ORDER BY total_ms DESC, code) AS rn FROM (SELECT imsi, date, code,
          CAST(sum(duration) AS BIGINT) AS total_ms, arg_min(s_time, ({ORDER})) AS s_time,
          arg_min(e_time, ({ORDER})) AS e_time, arg_min(lon, ({ORDER})) AS lon,
          arg_min(lat, ({ORDER})) AS lat FROM {source} WHERE code<>home GROUP BY imsi, date, code))
      WHERE rn=1 AND total_ms > 3600000)"""


HOMED = TRACE + ", homed AS (SELECT tr.*, live_aoi AS home FROM tr JOIN subs USING (imsi))"


@query(
    "max_dwell_destination",
    HOMED + f" SELECT imsi, date, code, total_ms, s_time, e_time FROM {dwell_sql('homed')}",
)
def _(t):
    return E.max_dwell_destination(t.trace(), t.subscribers())


DAY_OD = (
    HOMED
    + f""", fh AS (SELECT imsi, date, arg_min(code, ({ORDER})) AS o_code,
      arg_min(e_time, ({ORDER})) AS o_e, arg_min(lon, ({ORDER})) AS o_lon,
      arg_min(lat, ({ORDER})) AS o_lat FROM homed WHERE code=home GROUP BY ALL),
    cut AS (SELECT h.* FROM homed h JOIN fh USING (imsi, date)
      WHERE s_time >= least(o_e, {MIDNIGHT} + 28800000) AND e_time <= {MIDNIGHT} + 61200000),
    pair AS (SELECT d.imsi, d.date, o_code, d.code AS d_code, d.s_time - o_e AS time_ms,
      d.lon, d.lat, o_lon, o_lat FROM {dwell_sql('cut')} d JOIN fh USING (imsi, date)),
    day_od AS (SELECT imsi, date, o_code, d_code, time_ms,
      sqrt(pow(x-ox,2)+pow(y-oy,2)) AS distance, abs(x-ox)+abs(y-oy) AS manhattan_distance
      FROM {project(project('pair'), 'o_lon', 'o_lat', 'ox', 'oy')})"""
)


@query(
    "one_day_od",
    DAY_OD
    + """ SELECT imsi, date, o_code, d_code, time_ms, round(distance,3) AS distance,
    round(manhattan_distance,3) AS manhattan_distance FROM day_od""",
)
def _(t):
    return rounded(E.one_day_od(t.trace(), t.subscribers(), clock=UTC))


@query(
    "order_traces_by_day",
    TRACE + " SELECT imsi, date, count(*) AS stays FROM tr GROUP BY ALL ORDER BY imsi, date DESC",
)
def _(t):
    return E.order_traces_by_day(t.trace())
