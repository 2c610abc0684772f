"""Crowds and their insights."""

from pyspark.sql import functions as F

from testbed.queries.places import MOBILITY, mobility
from testbed.queries.traces import DAY_OD, HW, MEDIANS
from testbed.registry import query
from testbed.sqlviews import TRACE
from waymarks.functions.calendar import UTC
from waymarks.operators import crowds as G
from waymarks.operators import traces as E


@query("headcount", "SELECT count(DISTINCT imsi) AS users FROM iv")
def _(t):
    return G.headcount(t.intervals())


@query("crowd_is_empty", "SELECT count(*)=0 AS is_empty FROM subs WHERE age>200")
def _(t):
    return G.crowd_is_empty(t.subscribers().where(F.col("age") > 200))


@query("crowd_non_empty", "SELECT count(*)>0 AS non_empty FROM subs")
def _(t):
    return G.crowd_non_empty(t.subscribers())


@query(
    "crowd_add_user",
    """SELECT imsi, CASE WHEN age<30 THEN age+100 ELSE age END AS age FROM subs
    WHERE age<30 OR gender='Male'""",
)
def _(t):
    users = t.subscribers().select("imsi", "age", "gender")
    crowd = users.where(F.col("gender") == "Male")
    new = users.where(F.col("age") < 30).withColumn("age", F.col("age") + 100)
    return G.crowd_add_users(crowd, new).select("imsi", "age")


@query("crowd_by_live", "SELECT imsi FROM subs WHERE live_aoi='C3'")
def _(t):
    return G.crowd_by_live(t.subscribers(), "AOI", "C3").select("imsi")


@query("crowd_by_work", "SELECT imsi FROM subs WHERE work_grid='C3'")
def _(t):
    return G.crowd_by_work(t.subscribers(), "GRID", "C3").select("imsi")


@query("sub_crowd_by_live", "SELECT imsi, age FROM subs WHERE live_grid='C5'")
def _(t):
    return G.crowd_by_live(t.subscribers(), "GRID", "C5").select("imsi", "age")


@query("sub_crowd_by_work", "SELECT imsi, age FROM subs WHERE work_aoi='C5'")
def _(t):
    return G.crowd_by_work(t.subscribers(), "AOI", "C5").select("imsi", "age")


@query("sub_crowd_live_work", "SELECT imsi FROM subs WHERE live_aoi='C3' AND work_aoi='C9'")
def _(t):
    return G.crowd_live_work(t.subscribers(), "AOI", "C3", "C9").select("imsi")


ANY_LIVE = "'C3' IN (live_aoi, live_grid, live_sector)"


@query("live_crowd_any_kind", f"SELECT imsi FROM subs WHERE {ANY_LIVE}")
def _(t):
    return G.live_crowd_any_kind(t.subscribers(), "C3").select("imsi")


@query(
    "work_crowd_any_kind",
    "SELECT imsi FROM subs WHERE 'C3' IN (work_aoi, work_grid, work_sector)",
)
def _(t):
    return G.work_crowd_any_kind(t.subscribers(), "C3").select("imsi")


@query(
    "migrant_crowd",
    MOBILITY + " SELECT imsi FROM subs WHERE imsi IN (SELECT imsi FROM mob WHERE mobility='MIGRANT')",
)
def _(t):
    return G.migrant_crowd(t.subscribers(), mobility(t)).select("imsi")


@query(
    "travel_out_crowd",
    DAY_OD + f" SELECT imsi FROM subs WHERE {ANY_LIVE} AND imsi IN (SELECT imsi FROM day_od)",
)
def _(t):
    users = t.subscribers()
    ods = E.one_day_od(t.trace(), users, clock=UTC)
    return G.travel_out_crowd(users, "C3", ods).select("imsi")


@query(
    "crowd_to_destination",
    DAY_OD
    + f""" SELECT imsi FROM subs WHERE {ANY_LIVE} AND imsi IN
    (SELECT imsi FROM day_od WHERE d_code='C6')""",
)
def _(t):
    users = t.subscribers()
    ods = E.one_day_od(t.trace(), users, clock=UTC)
    return G.crowd_to_destination(users, "C3", ods, "C6").select("imsi")


@query(
    "linger_crowd",
    TRACE
    + """ SELECT imsi FROM subs WHERE imsi IN (SELECT imsi FROM tr WHERE code='C3'
    AND s_time < 1704974400000 AND e_time > 1704888000000)""",
)
def _(t):
    return G.linger_crowd(
        t.subscribers(), t.trace(), "C3", 1704888000000, 1704974400000
    ).select("imsi")


@query(
    "gender_insight",
    """SELECT count(*) FILTER (gender='Male') AS male, count(*) FILTER (gender<>'Male') AS female,
    count(*) FILTER (gender='Male')/count(*) AS male_ratio,
    count(*) FILTER (gender<>'Male')/count(*) AS female_ratio FROM subs""",
)
def _(t):
    return G.gender_insight(t.subscribers())


@query("arpu_insight", "SELECT round(sum(income),2) AS total_arpu FROM subs")
def _(t):
    return G.arpu_insight(t.subscribers()).select(F.round("total_arpu", 2).alias("total_arpu"))


@query(
    "network_5g_insight",
    """SELECT count(*) FILTER (network='G5') AS users_5g,
    round(count(*) FILTER (network='G5')/count(*),9) AS share_5g FROM subs""",
)
def _(t):
    return G.network_5g_insight(t.subscribers()).withColumn("share_5g", F.round("share_5g", 9))


@query(
    "crowd_commute_mean",
    HW
    + MEDIANS
    + """ SELECT direction, CAST(floor(avg(median_ms)) AS BIGINT) AS mean_ms FROM med
    WHERE imsi IN (SELECT imsi FROM subs WHERE gender='Male') GROUP BY ALL""",
)
def _(t):
    users = t.subscribers()
    medians = E.commute_median(t.trace(), users, line=t.daily())
    return G.crowd_commute_mean(users.where(F.col("gender") == "Male"), medians)


@query(
    "head_density",
    "SELECT count(DISTINCT imsi) AS users, round(count(DISTINCT imsi)/3e2,9) AS density FROM subs",
)
def _(t):
    return G.head_density(t.subscribers()).withColumn("density", F.round("density", 9))


@query(
    "linger_crowds",
    """, w AS (SELECT event_id AS w, concat('C', k//10) AS code, s_time AS f, s_time + 7200000 AS u FROM ev
      WHERE event_id%50=0)
    SELECT DISTINCT w AS "window", imsi FROM w JOIN iv_county iv USING (code)
    WHERE iv.s_time < u AND iv.e_time > f""",
)
def _(t):
    """Windows of two hours around every fiftieth event, against all stays."""
    e = t.intervals("county").where(F.col("event_id") % 50 == 0)
    windows = e.select(
        F.col("event_id").alias("window"),
        "code",
        F.col("s_time").alias("start"),
        (F.col("s_time") + 7_200_000).alias("end"),
    )
    return G.linger_crowds(t.intervals("county"), windows)
