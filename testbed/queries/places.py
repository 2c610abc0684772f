"""Home and work places, stay kinds and mobility."""

from pyspark.sql import functions as F

from testbed.registry import query
from testbed.sqlviews import MIDNIGHT, TRACE
from waymarks.functions.calendar import UTC
from waymarks.operators import places as P


def hour(c: str) -> str:
    return f"(({c}//3600000)%24)"


NIGHT = f"({hour('s_time')}<=6 OR {hour('s_time')}>=22 OR {hour('e_time')}<=6 OR {hour('e_time')}>=22)"
WORK_MS = f"CASE WHEN {hour('s_time')}>8 AND {hour('e_time')}<17 THEN e_time-s_time ELSE 0 END"


def steady(hits: str, share: str) -> str:
    return f""", best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY imsi
        ORDER BY days DESC, code) AS rn FROM {hits}) WHERE rn=1),
      present AS (SELECT imsi, count(DISTINCT date) AS total_days FROM tr GROUP BY imsi)
      SELECT imsi, code, days, total_days FROM best JOIN present USING (imsi)
      WHERE total_days > 10 AND days/total_days > {share}"""


@query("night_stays", TRACE + f" SELECT imsi, date, event_id, code FROM tr WHERE {NIGHT}")
def _(t):
    return P.night_stays(t.trace(), UTC).select("imsi", "date", "event_id", "code")


@query("work_stays", TRACE + f" SELECT imsi, date, event_id, {WORK_MS} AS work_ms FROM tr")
def _(t):
    return P.work_stays(t.trace(), UTC).select("imsi", "date", "event_id", "work_ms")


@query(
    "live_place",
    TRACE
    + steady(
        f"(SELECT imsi, code, count(DISTINCT date) AS days FROM tr WHERE {NIGHT} GROUP BY ALL)",
        "15e-2",
    ),
)
def _(t):
    return P.live_place(t.trace(), min_days=10, min_share=0.15, clock=UTC)


@query(
    "work_place",
    TRACE
    + steady(
        f"""(SELECT imsi, code, count(*) AS days FROM (SELECT imsi, code, date, sum({WORK_MS}) AS ms
        FROM tr GROUP BY ALL) WHERE ms > 3600000 GROUP BY ALL)""",
        "5e-2",
    ),
)
def _(t):
    return P.work_place(t.trace(), min_days=10, min_share=0.05, clock=UTC)


@query("place_of_kind", "SELECT imsi, live_grid AS live_code, work_grid AS work_code FROM subs")
def _(t):
    return P.place_of_kind(t.subscribers(), "GRID")


def inside(a: int, b: int) -> str:
    return (
        f"greatest(least(e_time, {MIDNIGHT}+{a * 3600000 + (b - a) * 3600000})"
        f" - greatest(s_time, {MIDNIGHT}+{a * 3600000}), 0)"
    )


@query(
    "stay_kind",
    TRACE
    + f""", d AS (SELECT imsi, date, code, sum({inside(21, 29)}) AS night, sum({inside(9, 17)}) AS work
      FROM tr GROUP BY ALL),
    l AS (SELECT imsi, date, arg_min(code, (-night, code)) AS live FROM d WHERE night>0 GROUP BY ALL),
    w AS (SELECT imsi, date, arg_min(code, (-work, code)) AS office FROM d WHERE work>0 GROUP BY ALL)
    SELECT imsi, date, event_id, code, CASE WHEN code=live AND code=office THEN 'WORKLIVE'
      WHEN code=live THEN 'LIVE' WHEN code=office THEN 'WORK'
      WHEN e_time-s_time > 1800000 THEN 'LINGER' ELSE 'PASSBY' END AS kind
    FROM tr LEFT JOIN l USING (imsi, date) LEFT JOIN w USING (imsi, date)""",
)
def _(t):
    return P.stay_kind(t.trace(), UTC).select("imsi", "date", "event_id", "code", "kind")


MOBILITY = (
    TRACE
    + """, pu AS (SELECT imsi, CAST(CAST(max(date) AS DATE) - CAST(min(date) AS DATE) AS INTEGER)
      AS span_days, count(DISTINCT CASE WHEN code='C3' THEN date END) AS days FROM tr GROUP BY imsi),
    mob AS (SELECT *, CASE WHEN span_days<27 OR span_days>367 THEN 'LessDate' WHEN days>8 THEN 'INHABITANT'
      WHEN days>4 THEN 'MIGRANT' WHEN days>0 THEN 'TRANSIT' ELSE 'ABSENT' END AS mobility FROM pu)"""
)


def mobility(t):
    return P.mobility_class(t.trace(), "C3", inhabitant_days=8, migrant_days=4, min_span_days=27)


@query("mobility_class", MOBILITY + " SELECT * FROM mob")
def _(t):
    return mobility(t)


@query(
    "is_inhabitant",
    MOBILITY + " SELECT imsi, CAST(mobility='INHABITANT' AS INTEGER) AS is_inhabitant FROM mob",
)
def _(t):
    return P.mobility_flags(mobility(t)).select("imsi", "is_inhabitant")


@query(
    "is_migrant", MOBILITY + " SELECT imsi, CAST(mobility='MIGRANT' AS INTEGER) AS is_migrant FROM mob"
)
def _(t):
    return P.mobility_flags(mobility(t)).select("imsi", "is_migrant")


@query(
    "is_transient",
    TRACE
    + """ SELECT imsi, date, CAST(sum(duration) AS BIGINT) AS total_ms FROM tr WHERE code='C3'
    AND imsi IN (SELECT imsi FROM subs) GROUP BY ALL HAVING sum(duration) < 21600000""",
)
def _(t):
    return P.is_transient(t.trace(), t.subscribers(), "C3")


@query(
    "home_and_work",
    TRACE
    + f""", dy AS (SELECT imsi, count(DISTINCT date) AS total_days FROM tr GROUP BY imsi),
    nt AS (SELECT imsi, code, count(DISTINCT date) AS days FROM tr WHERE {NIGHT} GROUP BY ALL),
    wk AS (SELECT imsi, code, count(*) AS days FROM (SELECT imsi, code, date, sum({WORK_MS}) AS ms
      FROM tr GROUP BY ALL) WHERE ms > 3600000 GROUP BY ALL),
    hm AS (SELECT imsi, arg_min(code, (-days, code)) AS code, max(days) AS days FROM nt GROUP BY imsi),
    ofc AS (SELECT imsi, arg_min(code, (-days, code)) AS code, max(days) AS days FROM wk GROUP BY imsi)
    SELECT imsi, CASE WHEN total_days>10 AND hm.days/total_days > 15e-2 THEN hm.code END AS live_code,
      CASE WHEN total_days>10 AND ofc.days/total_days > 5e-2 THEN ofc.code END AS work_code, total_days
    FROM dy LEFT JOIN hm USING (imsi) LEFT JOIN ofc USING (imsi)""",
)
def _(t):
    return P.home_and_work(t.trace(), 10, 0.15, 0.05, clock=UTC)
