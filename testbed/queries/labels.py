"""Crowd labels."""

from pyspark.sql import functions as F

from testbed.registry import query
from testbed.sqlviews import project
from waymarks.functions.calendar import UTC
from waymarks.operators import labels as B


@query(
    "driver_labels_by_revisit",
    """, d AS (SELECT imsi, date, count(*) AS n, count(*) - count(DISTINCT code) AS rep
      FROM iv_county GROUP BY ALL),
    u AS (SELECT imsi, CAST(sum(n) AS BIGINT) AS stays, avg(rep) AS m FROM d GROUP BY imsi)
    SELECT imsi, stays, round(m,6) AS mean_repeats, CASE WHEN m<2e-1 THEN '出租车司机'
      WHEN m>2e-1 AND m<4e-1 THEN '快递人员' ELSE '公交车司机' END AS crowd_name
    FROM u WHERE stays>50 AND m<>2e-1 AND m<>4e-1""",
)
def _(t):
    labels = B.driver_labels_by_revisit(t.intervals("county"), 50, 0.2, 0.4)
    return labels.withColumn("mean_repeats", F.round("mean_repeats", 6))


@query(
    "driver_labels_by_features",
    f""", s AS (SELECT a.*, b.event_type='purchase' AS called FROM iv_county a JOIN ev b USING (event_id)),
    c AS (SELECT imsi, code, count(*) AS v, count(*) FILTER (called) AS k FROM s GROUP BY ALL),
    f AS (SELECT imsi, count(*) AS cells, avg(v) AS visits, CAST(sum(k) AS BIGINT) AS calls,
      coalesce(avg(CASE WHEN k>0 THEN k END), 0) AS calls_per_cell FROM c GROUP BY imsi),
    l AS (SELECT imsi, sum(d) AS distance FROM (SELECT imsi, sqrt(pow(x-lag(x) OVER w,2)
        + pow(y-lag(y) OVER w,2)) AS d FROM {project('s')}
        WINDOW w AS (PARTITION BY imsi ORDER BY s_time, event_id)) GROUP BY imsi),
    z AS (SELECT *, CASE WHEN distance>300 AND cells>2 AND visits<7 AND calls>12 THEN '出租车司机'
      WHEN distance>300 AND cells>2 AND visits>7 AND calls_per_cell<2 AND calls<12 THEN '公交车司机'
      WHEN distance>300 AND cells>2 AND visits>7 AND calls_per_cell>2 AND calls>12 THEN '快递人员'
      END AS crowd_name FROM f JOIN l USING (imsi))
    SELECT imsi, round(distance,2) AS distance, cells, round(visits,6) AS visits, calls,
      round(calls_per_cell,6) AS calls_per_cell, crowd_name FROM z WHERE crowd_name IS NOT NULL""",
)
def _(t):
    called = t.events().select("event_id", (F.col("event_type") == "purchase").alias("called"))
    stays = t.intervals("county").join(called, "event_id")
    cuts = B.DriverCuts(visits=7, calls_per_cell=2, calls=12)
    labels = B.driver_labels_by_features(stays, t.lifetime(), cuts)
    return labels.withColumns(
        {
            "distance": F.round("distance", 2),
            "visits": F.round("visits", 6),
            "calls_per_cell": F.round("calls_per_cell", 6),
        }
    )


def area_name(kind: int) -> str:
    return f"(SELECT CAST(eci AS VARCHAR) AS cell, concat(scene_name, county_id) AS name FROM cells WHERE k%10={kind})"


def at(kind: int, side: str) -> str:
    return f"(SELECT min(name) FROM {area_name(kind)} a WHERE a.cell={side}_cell)"


SITES = "CAST(work_cell AS BIGINT)//256 <> CAST({}_cell AS BIGINT)//256"


@query(
    "place_labels",
    f""", u AS (SELECT *, {at(2, 'work')} AS ws, {at(2, 'home')} AS hs, {at(2, 'holiday')} AS os,
      {at(3, 'work')} AS wh, {at(3, 'home')} AS hh, {at(4, 'work')} AS wb FROM subs)
    SELECT imsi, phone, imei, '教务人员' AS crowd_name FROM u WHERE ws IS NOT NULL AND
      CASE WHEN home_cell<>work_cell THEN os<>ws ELSE income>100 END
    UNION ALL SELECT imsi, phone, imei, '学生' FROM u WHERE ws IS NOT NULL AND hs IS NOT NULL AND age<23
    UNION ALL SELECT imsi, phone, imei, '医务工作者' FROM u WHERE wh IS NOT NULL AND
      wh IS DISTINCT FROM hh AND {SITES.format('home')} AND {SITES.format('holiday')}
    UNION ALL SELECT imsi, phone, imei, '商务人员' FROM u WHERE wb IS NOT NULL AND age BETWEEN 18 AND 70
      AND {SITES.format('home')} AND income>1000""",
)
def _(t):
    kind = F.col("k") % 10
    areas = t.cells().select(
        F.col("eci").cast("string").alias("cell"),
        F.when(kind == 2, "school").when(kind == 3, "hospital").when(kind == 4, "business").alias(
            "kind"
        ),
        F.concat("scene_name", "county_id").alias("name"),
    )
    return B.place_labels(t.subscribers(), areas.where(F.col("kind").isNotNull()), 100, 1000)


HOUR = "(({}//3600000)%24)"
OFFICE = f"({HOUR.format('s_time')}>=8 AND {HOUR.format('e_time')}<=20)"
WEEKEND = "isodow(make_timestamp(s_time*1000))>=6"


def weekend_sql(stays: str, imei: str = "imei") -> str:
    return f""", st AS (SELECT s.imsi, s.code, {WEEKEND} AS we, {OFFICE} AS office, u.work_cell FROM {stays} s
      JOIN subs u USING (imsi)),
    ct AS (SELECT imsi, count(*) FILTER (we AND code=work_cell) AS won,
      count(*) FILTER (we AND code<>work_cell) AS woff,
      count(*) FILTER (office AND code=work_cell) AS ins,
      count(*) FILTER (NOT office AND code=work_cell) AS outs FROM st GROUP BY imsi),
    u AS (SELECT subs.*, won, woff, ins, outs,
      (SELECT scene_name FROM cells WHERE CAST(eci AS VARCHAR)=home_cell) AS h,
      (SELECT scene_name FROM cells WHERE CAST(eci AS VARCHAR)=work_cell) AS w
      FROM subs JOIN ct USING (imsi))
    SELECT imsi, phone, {imei} AS imei, '教务人员' AS crowd_name FROM u WHERE h IS NOT NULL AND w='学校' AND age>23
      AND CASE WHEN h<>w THEN woff>won ELSE income>100 END
    UNION ALL SELECT imsi, phone, {imei} AS imei, '学生' FROM u WHERE w='学校' AND age<23
    UNION ALL SELECT imsi, phone, {imei} AS imei, '医务工作者' FROM u WHERE h IS NOT NULL AND w='医院' AND age>23
      AND h<>w AND woff>won
    UNION ALL SELECT imsi, phone, {imei} AS imei, '商务人员' FROM u WHERE h<>w AND age BETWEEN 18 AND 70 AND ins>outs"""


@query("place_labels_weekend", weekend_sql("iv_eci"))
def _(t):
    scenes = t.cells().select(
        F.col("eci").cast("string").alias("cell"), F.col("scene_name").alias("scene")
    )
    return B.place_labels_weekend(t.intervals("eci"), t.subscribers(), scenes, UTC)


@query(
    "driver_labels_published",
    """, d AS (SELECT imsi, date, count(*) AS n, count(*) - count(DISTINCT code) AS rep
      FROM iv_county GROUP BY ALL),
    u AS (SELECT imsi, sum(n) AS stays, avg(rep) AS m FROM d GROUP BY imsi)
    SELECT imsi, coalesce(phone, '') AS msisdn, coalesce(imei, '') AS imei, CASE WHEN m<2e-1 THEN '出租车司机'
      WHEN m>2e-1 AND m<4e-1 THEN '快递人员' ELSE '公交车司机' END AS crowd_name, '20240131' AS stat_date
    FROM u LEFT JOIN subs USING (imsi) WHERE stays>50 AND m<>2e-1 AND m<>4e-1""",
)
def _(t):
    labels = B.driver_labels_by_revisit(t.intervals("county"), 50, 0.2, 0.4)
    return B.published_labels(labels, t.subscribers(), "20240131")
