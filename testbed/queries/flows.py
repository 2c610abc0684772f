"""Hourly area flows and flows between areas."""

from pyspark.sql import functions as F

from testbed.registry import query
from testbed.sqlviews import merge, smooth
from waymarks.functions.calendar import UTC
from waymarks.operators import flows as L

AREA = f""", rl AS (SELECT iv.* REPLACE (coalesce(c.county_id, '') AS code) FROM iv
    LEFT JOIN cells c ON iv.code=c.code AND iv.rat=c.rat AND c.code<>'0'),
  m AS (SELECT * FROM {merge(smooth('rl'), midpoint=False)})"""


def roles(stays: str) -> str:
    return f""", r AS (SELECT imsi, code, s_time//3600000 AS h, 'in' AS role FROM {stays}
    UNION ALL SELECT imsi, code, e_time//3600000, 'out' FROM {stays}
    UNION ALL SELECT imsi, code, unnest(range(s_time//3600000+1, e_time//3600000)), 'stay' FROM {stays})"""


def counts(count: str = "count(*)", what: str = "") -> str:
    def c(role: str) -> str:
        return f"{count} FILTER (role='{role}')" if not what else (
            f"count(DISTINCT CASE WHEN role='{role}' THEN imsi END)"
        )

    return f"""(SELECT strftime(make_timestamp(h*3600000000), '%Y%m%d %H:00:00') AS hour_stamp, code,
      {c('stay')} + {c('in')} - {c('out')} AS total, {c('stay')} AS stay_count,
      {c('in')} AS in_count, {c('out')} AS out_count FROM r GROUP BY h, code)"""


NAMES = "(SELECT county_id AS code, min(county_name) AS name, min(city_id) AS city_id FROM cells GROUP BY 1)"


@query(
    "hourly_area_flow",
    AREA + roles("m") + f" SELECT * FROM {counts()} LEFT JOIN {NAMES} USING (code)",
)
def _(t):
    return L.hourly_area_flow(t.intervals(), t.cells(), clock=UTC, line=t.daily())


@query(
    "hourly_area_flow_distinct",
    AREA + roles("m") + f" SELECT * FROM {counts(what='imsi')} LEFT JOIN {NAMES} USING (code)",
)
def _(t):
    return L.hourly_area_flow(t.intervals(), t.cells(), clock=UTC, distinct=True, line=t.daily())


@query(
    "hourly_custom_area_flow",
    f""", rl AS (SELECT iv.* REPLACE (coalesce(c.area, '') AS code) FROM iv LEFT JOIN
      (SELECT code, CASE WHEN k%10<2 THEN 'hubs' ELSE 'campus' END AS area FROM cells WHERE k%10<3 AND code<>'0') c
      ON iv.code=c.code),
    m AS (SELECT * FROM {merge(smooth('rl'), midpoint=False)} WHERE code<>'')"""
    + roles("m")
    + f""" SELECT * FROM {counts()} WHERE total>0 AND stay_count>0 AND in_count>0
      AND out_count>0""",
)
def _(t):
    kind = F.col("k") % 10
    area = t.cells().where(kind < 3).select(
        "code", F.when(kind < 2, "hubs").otherwise("campus").alias("area_code")
    )
    return L.hourly_custom_area_flow(t.intervals(), area, clock=UTC, line=t.daily())


@query(
    "area_transition_flow",
    f""", rl AS (SELECT iv.* REPLACE (CASE WHEN c.code IS NULL THEN ''
      ELSE concat(c.city_id, '_', c.county_id) END AS code) FROM iv LEFT JOIN cells c ON iv.code=c.code AND iv.rat=c.rat AND c.code<>'0'),
    m AS (SELECT * FROM {merge(smooth('rl'), midpoint=False)}),
    p AS (SELECT *, lag(code) OVER w AS a, lag(e_time) OVER w AS left_at FROM m
      WINDOW w AS (PARTITION BY imsi, date ORDER BY s_time, event_id)),
    f AS (SELECT date, imsi, a, code AS b, 'out' AS direction, left_at AS tm FROM p WHERE a IS NOT NULL
      UNION ALL SELECT date, imsi, code, a, 'in', s_time FROM p WHERE a IS NOT NULL)
    SELECT date AS date_day, split_part(a,'_',1) AS city1, split_part(a,'_',2) AS district1,
      split_part(b,'_',1) AS city2, split_part(b,'_',2) AS district2, direction,
      concat(lpad(CAST((tm//3600000)%24 AS VARCHAR),2,'0'), '-',
        lpad(CAST((tm//3600000)%24+1 AS VARCHAR),2,'0')) AS time_second,
      count(DISTINCT imsi) AS user_num FROM f GROUP BY ALL""",
)
def _(t):
    return L.area_transition_flow(t.intervals(), t.cells(), clock=UTC, line=t.daily())


@query(
    "flow_rejects",
    """SELECT event_id, CASE WHEN k%5=0 THEN 'no time' WHEN k%5=1 THEN 'ends before it starts'
    ELSE 'too long' END AS reason FROM ev WHERE k%5<3""",
)
def _(t):
    """Ends that are missing, before the start, or never."""
    k = F.col("k") % 5
    broken = F.when(k == 1, F.col("s_time") - 1).when(k == 2, F.lit(9 * 10**15))
    end = F.when(k > 2, F.col("s_time") + 1000).when(k > 0, broken)
    stays = t.events().withColumn("e_time", end.cast("bigint"))
    return L.flow_rejects(stays).select("event_id", "reason")
