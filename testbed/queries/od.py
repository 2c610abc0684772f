"""Origin-destination tables."""

from pyspark.sql import functions as F

from testbed.queries.traces import HW, passage_sql
from testbed.registry import query
from testbed.sqlviews import TRACE, aggregate, merge, project, smooth
from waymarks.operators import od as O
from waymarks.operators import stays as S
from waymarks.operators import traces as E


@query(
    "od_legs",
    TRACE
    + f""" SELECT imsi, date, o_event_id, event_id AS d_event_id, o_e_time AS depart, s_time AS arrive
    FROM {passage_sql("'C1'", "'C2'")}""",
)
def _(t):
    legs = O.od_legs(t.trace(), F.lit("C1"), F.lit("C2"), line=t.daily())
    return legs.select(
        "imsi",
        "date",
        F.col("o.event_id").alias("o_event_id"),
        F.col("d.event_id").alias("d_event_id"),
        F.col("o.e_time").alias("depart"),
        F.col("d.s_time").alias("arrive"),
    )


BEHAVIOUR = f""", b AS (SELECT imsi, date, o_event_id, o_code, code AS d_code, s_time-o_e_time AS time_ms,
    sqrt(pow(dx-ox,2)+pow(dy-oy,2)) AS distance, abs(dx-ox)+abs(dy-oy) AS manhattan_distance FROM
    {project(project('legs', x='dx', y='dy'), 'o_lon', 'o_lat', 'ox', 'oy')})"""


@query(
    "od_behaviour",
    HW
    + BEHAVIOUR
    + """ SELECT imsi, date, o_event_id, o_code, d_code, time_ms, round(distance,3) AS distance,
    round(manhattan_distance,3) AS manhattan_distance FROM b""",
)
def _(t):
    legs = E.home_work_passages(t.trace(), t.subscribers(), line=t.daily())
    return (
        O.od_behaviour(legs)
        .withColumns(
            {
                "distance": F.round("distance", 3),
                "manhattan_distance": F.round("manhattan_distance", 3),
            }
        )
        .drop("direction")
    )


@query(
    "od_summary",
    HW
    + BEHAVIOUR
    + """ SELECT o_code, d_code, count(DISTINCT imsi) AS users,
    CAST(floor(avg(time_ms)) AS BIGINT) AS mean_time_ms, round(avg(distance),3) AS mean_distance,
    round(avg(manhattan_distance),3) AS mean_manhattan FROM b GROUP BY ALL""",
)
def _(t):
    legs = E.home_work_passages(t.trace(), t.subscribers(), line=t.daily())
    return O.od_summary(O.od_behaviour(legs)).withColumns(
        {
            "mean_distance": F.round("mean_distance", 3),
            "mean_manhattan": F.round("mean_manhattan", 3),
        }
    )


FIELDS = ("code", "place_code", "place_name", "place_scene", "s_time", "e_time", "x", "y")


def table_sql(level: str, measured: bool = True, phone: str = "NULL", home: str = "NULL",
              imsi: str = "imsi") -> str:
    side = ", ".join(
        f"{p}_code AS {P}_cellID, {p}_place_code AS {P}_{level}_code, {p}_place_name AS "
        f"{P}_{level}_name, {p}_place_scene AS {P}_cell_state, {p}_s_time AS {P}_in_time, "
        f"{p}_e_time AS {P}_out_time"
        for p, P in (("o", "O"), ("d", "D"))
    )
    seconds = "floor((d_s_time-o_e_time)/1000)"
    metres = "sqrt(pow(d_x-o_x,2)+pow(d_y-o_y,2))"
    measures = (
        f"""round({metres}/1000,6) AS OD_{level}_distance,
      sign({seconds})*((abs(CAST({seconds} AS BIGINT))+18)//36)/1e2 AS OD_{level}_duration,
      CASE WHEN {seconds}<>0 THEN round({metres}/{seconds},2) END AS OD_{level}_velocity,"""
        if measured
        else ""
    )
    return f"""SELECT date AS date_day, {imsi} AS imsi, CAST({phone} AS VARCHAR) AS msisdn, {side},
      {measures} '' AS OD_{level}_type, CAST({home} AS VARCHAR) AS home_province FROM ch"""


def change_sql(source: str, keys: str = "imsi, date", compat: bool = False,
               label: str = "place_code", skip_blank: bool = False) -> str:
    """``ch``: rows where the place changes, with both ends."""
    here = ", ".join(f"{f} AS d_{f}" for f in FIELDS)
    w = f"(PARTITION BY {keys} ORDER BY s_time, event_id)"
    if skip_blank:
        known = f"coalesce({label},'')<>''"
        lags = ", ".join(
            f"lag(CASE WHEN {known} THEN {f} END) OVER {w} AS o_{f}" for f in FIELDS
        )
        return f""", ch AS (SELECT * FROM (SELECT *, {here}, {lags},
            lag({label}) OVER {w} AS was FROM {source} WHERE {known})
          WHERE was IS NOT NULL AND {label} <> was)"""
    if not compat:
        lags = ", ".join(f"lag({f}) OVER {w} AS o_{f}" for f in FIELDS)
        return f""", ch AS (SELECT * FROM (SELECT *, {here}, {lags},
            row_number() OVER {w} AS rn, lag({label}) OVER {w} AS was FROM {source})
          WHERE rn>1 AND coalesce({label},'') <> coalesce(was,''))"""
    lags = ", ".join(
        f"CASE WHEN rn<=2 OR rn=n THEN {f} ELSE lag({f}) OVER {w} END AS o_{f}" for f in FIELDS
    )
    return f""", ch AS (SELECT * FROM (SELECT *, {here}, {lags}, lag({label}) OVER {w} AS was
        FROM (SELECT *, row_number() OVER {w} AS rn,
          count(*) OVER (PARTITION BY {keys}) AS n FROM {source}))
      WHERE coalesce({label},'') <> coalesce(was,''))"""


def labelled(level: str) -> str:
    """Cell stays of points with the place columns; hub cells have no county, to have blanks."""
    return f""", st AS (SELECT a.*, c.{level}_id AS place_code, c.{level}_name AS place_name,
      c.scene_name AS place_scene FROM {aggregate('pt')} a LEFT JOIN
      (SELECT * FROM cells WHERE scene_id<>'YDY2' AND code<>'0') c ON a.code=c.code AND a.rat=c.rat),
    lb AS (SELECT * FROM {project('st')})"""


def dim(t):
    """Area dimension without the airport cells, so that some stays have no place."""
    return t.cells().where(F.col("scene_id") != "YDY2")


@query("county_od", labelled("county") + change_sql("lb") + " " + table_sql("county"))
def _(t):
    return O.area_od(S.stay_aggregate(t.points(), line=t.daily()), dim(t), "county", line=t.daily())


@query(
    "county_od_compat",
    labelled("county") + change_sql("lb", compat=True) + " " + table_sql("county"),
)
def _(t):
    return O.area_od(S.stay_aggregate(t.points(), line=t.daily()), dim(t), "county", compat=True, line=t.daily())


@query("city_od", labelled("city") + change_sql("lb") + " " + table_sql("city"))
def _(t):
    return O.area_od(S.stay_aggregate(t.points(), line=t.daily()), dim(t), "city", line=t.daily())


PLACE = {
    "province": "province_code AS place_code, province_name AS place_name",
    "country": """country_code AS place_code,
      concat(country_name, '|', country_name_en) AS place_name""",
}


def lookup_sql(level: str, roam: str = "roam") -> str:
    """Signalling rows with the roaming row in force, merged by cell, per phone."""
    return f""", rf AS (SELECT phone, event_id, s_time, e_time, {PLACE[level]} FROM {roam}),
    sg AS (SELECT * REPLACE (s_time AS s_time), substr(msisdn, 3) AS phone FROM sig),
    lk AS (SELECT g.phone, g.imsi, g.date, g.home_province, g.event_id, g.cell AS code, g.lon, g.lat,
        r.s_time, r.e_time, r.place_code, r.place_name, '' AS place_scene, 'ROAD' AS scene, 6 AS rat
      FROM (SELECT g.*, (SELECT max(r.s_time) FROM rf r WHERE r.phone=g.phone AND r.s_time<=g.s_time) AS at
        FROM sg g) g JOIN rf r ON r.phone=g.phone AND r.s_time=g.at),
    mg AS (SELECT * FROM {merge(smooth('lk', 'phone'), 'phone', midpoint=False, carry=(
        'imsi', 'date', 'home_province', 'place_code', 'place_name', 'place_scene'))}),
    pj AS (SELECT * FROM {project('mg')})"""


@query(
    "province_od_lookup",
    lookup_sql("province")
    + change_sql("pj", "phone")
    + " "
    + table_sql("province", phone="phone", home="home_province"),
)
def _(t):
    return O.od_lookup(t.signalling(), t.roaming(), "province", t.by_phone())


@query(
    "country_od_lookup",
    lookup_sql("country")
    + change_sql("pj", "phone")
    + " "
    + table_sql("country", False, phone="phone", home="home_province"),
)
def _(t):
    return O.od_lookup(t.signalling(), t.roaming(), "country", t.by_phone())


def roaming_sql(level: str, rows: str, phones: str, roam: str = "roam") -> str:
    return f""", sg AS (SELECT *, substr(msisdn, 3) AS phone FROM sig WHERE {phones}),
    rs AS (SELECT phone, date, event_id, s_time, e_time, {PLACE[level]}, '' AS place_scene FROM {roam}
      WHERE {rows} AND phone IN (SELECT phone FROM sg)),
    sm AS (SELECT * FROM {smooth('rs', 'phone')}),
    lc AS (SELECT sm.*, l.imsi, l.home_province, l.cell, l.lon, l.lat, 'ROAD' AS scene, 6 AS rat,
        CASE WHEN l.cell IS NULL THEN concat('row ', sm.event_id, '|', place_code)
          ELSE concat(l.cell, '|', place_code) END AS code
      FROM sm LEFT JOIN (SELECT phone, s_time//60000 AS mi, arg_max(imsi, (s_time, event_id)) AS imsi,
          arg_max(home_province, (s_time, event_id)) AS home_province,
          arg_max(cell, (s_time, event_id)) AS cell, arg_max(lon, (s_time, event_id)) AS lon,
          arg_max(lat, (s_time, event_id)) AS lat FROM sg GROUP BY ALL) l
        ON l.phone=sm.phone AND l.mi=sm.e_time//60000),
    mg AS (SELECT * REPLACE (cell AS code) FROM {merge('lc', 'phone', midpoint=False, carry=(
        'imsi', 'date', 'home_province', 'cell', 'place_code', 'place_name', 'place_scene'))}),
    pj AS (SELECT * FROM {project('mg')})"""


@query(
    "province_od_roaming",
    roaming_sql("province", "country_code='86' AND province_code<>''", "msisdn LIKE '86%'")
    + change_sql("pj", "phone", label="place_name", skip_blank=True)
    + " "
    + table_sql("province", phone="phone", home="home_province"),
)
def _(t):
    rows = t.roaming().where((F.col("country_code") == "86") & (F.col("province_code") != ""))
    heard = t.signalling().where(F.col("msisdn").startswith("86"))
    return O.od_roaming(heard, rows, "province", t.by_phone())


@query(
    "country_od_roaming",
    roaming_sql("country", "province_code<>''", "msisdn NOT LIKE '86%'")
    + change_sql("pj", "phone", label="place_name", skip_blank=True)
    + " "
    + table_sql("country", False, phone="phone", home="home_province"),
)
def _(t):
    rows = t.roaming().where(F.col("province_code") != "")
    heard = t.signalling().where(~F.col("msisdn").startswith("86"))
    return O.od_roaming(heard, rows, "country", t.by_phone())


@query(
    "province_od_signalling",
    f""", rf AS (SELECT phone, event_id, s_time, {PLACE["province"]} FROM roam WHERE country_code='86'),
    sg AS (SELECT *, substr(msisdn, 3) AS phone FROM sig),
    hp AS (SELECT *, cell AS code, 'ROAD' AS scene, 6 AS rat, '' AS source FROM sg
      WHERE phone IN (SELECT phone FROM rf)),
    st AS (SELECT * FROM {aggregate('hp', ''', arg_min(phone, (s_time, event_id)) AS phone,
      arg_min(date, (s_time, event_id)) AS date,
      arg_min(home_province, (s_time, event_id)) AS home_province''', 'imsi')}),
    pl AS (SELECT g.*, r.place_code, r.place_name, CASE WHEN r.phone IS NULL THEN NULL ELSE '' END
        AS place_scene FROM (SELECT st.*, (SELECT max(r.s_time) FROM rf r WHERE r.phone=st.phone
          AND r.s_time<=st.s_time) AS at FROM st) g LEFT JOIN rf r ON r.phone=g.phone AND r.s_time=g.at),
    pj AS (SELECT * FROM {project('pl')})"""
    + change_sql("pj", "imsi", skip_blank=True)
    + " "
    + table_sql("province", phone="phone", home="home_province"),
)
def _(t):
    rows = t.roaming().where(F.col("country_code") == "86")
    return O.province_od_signalling(t.signalling(), rows, t.lifetime(), t.by_phone())
