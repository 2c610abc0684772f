"""Jobs from files to files: reader, job, writer, and the written rows read back."""

from pyspark.sql import functions as F

from testbed.queries.geometry import GEOHASH
from testbed.queries.jobs import BY_END
from testbed.queries.labels import weekend_sql
from testbed.queries.od import change_sql, lookup_sql, roaming_sql, table_sql
from testbed.queries.sources import area_file, roaming_file, signalling_file, subscriber_file
from testbed.registry import query
from testbed.sqlviews import merge
from waymarks.functions.calendar import UTC
from waymarks.operators import labels as B
from waymarks.operators import od as O
from waymarks.plans import jobs as J
from waymarks.sources import readers as R
from waymarks.sources import writers as W

#: Lines of the signalling file that can be read; times have whole seconds.
READ = """, tsv AS (SELECT iv_eci.* REPLACE (s_time//1000*1000 AS s_time,
      e_time//1000*1000 AS e_time), concat('138', imsi) AS phone, concat('86', imsi) AS imei
    FROM iv_eci WHERE event_id%11<>0 AND event_id%13<>0 AND event_id%17<>0)"""
ROAM = """, roam_read AS (SELECT * REPLACE (s_time//1000*1000 AS s_time, e_time//1000*1000 AS e_time)
    FROM roam WHERE country_code='86' AND province_code<>'')"""


def written(t, df, kinds):
    """Rows written as tab text and read again."""
    path = t.scratch("result")
    W.write_text_replace(df.select(*kinds), path)
    part = F.split("value", "\t")
    fields = [F.nullif(F.get(part, i), F.lit("")).cast(k).alias(n) for i, (n, k) in enumerate(kinds.items())]
    return t.spark.read.text(path).select(*fields)


def kinds_of(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


@query(
    "cell_stay_table_text_files",
    READ
    + f""", m AS (SELECT * FROM {merge('tsv', keys='phone, imsi, imei, date', order=BY_END)})
    SELECT imsi, phone, imei, date, m.code AS cell, round(m.lon,6) AS longitude, round(m.lat,6) AS latitude,
      {GEOHASH.replace('(lon+', '(m.lon+').replace('(lat+', '(m.lat+')} AS geohash,
      'CHN' AS country_code, county_id AS county_code, s_time AS enter_time, e_time AS leave_time
    FROM m LEFT JOIN (SELECT CAST(eci AS VARCHAR) AS ec, county_id FROM cells WHERE k%9<>0 AND rat=6) c
      ON m.code=c.ec""",
)
def _(t):
    rows = R.read_signalling_tsv(t.spark, signalling_file(t), clock=UTC)
    counties = R.load_area_dim(t.spark, area_file(t)).where(F.col("rat") == 6)
    table = J.cell_stay_table_text(
        rows.withColumn("scene", F.lit("ROAD")), t.cells(), counties.select("code", "county_id"), J.IDENTITY
    )
    table = table.withColumns({c: F.round(c, 6) for c in ("longitude", "latitude")})
    return written(t, table, kinds_of(table))


@query(
    "interval_trace_count_files",
    READ
    + f""" SELECT phone, date, count(*) AS stays FROM {merge(
        "(SELECT * FROM tsv WHERE code IN (SELECT CAST(eci AS VARCHAR) FROM cells WHERE k%7<>0))",
        'phone, date', BY_END, midpoint=False)} GROUP BY ALL""",
)
def _(t):
    rows = R.read_signalling_tsv(t.spark, signalling_file(t), clock=UTC)
    counts = J.interval_trace_count(rows, t.cells().where(F.col("k") % 7 != 0))
    return written(t, counts, kinds_of(counts))


@query(
    "province_od_lookup_files",
    ROAM
    + lookup_sql("province", "roam_read")
    + change_sql("pj", "phone")
    + " SELECT * REPLACE (nullif(OD_province_type, '') AS OD_province_type, "
    + "nullif(O_cell_state, '') AS O_cell_state, nullif(D_cell_state, '') AS D_cell_state) FROM ("
    + table_sql("province", phone="phone", home="home_province")
    + ")",
)
def _(t):
    roaming = R.read_roaming_extract(t.spark, roaming_file(t), clock=UTC)
    table = O.od_lookup(t.signalling(), roaming, "province", t.by_phone())
    return written(t, table, kinds_of(table))


@query(
    "province_od_roaming_files",
    ROAM
    + roaming_sql("province", "true", "msisdn LIKE '86%'", "roam_read")
    + change_sql("pj", "phone", label="place_name", skip_blank=True)
    + " SELECT * REPLACE (nullif(OD_province_type, '') AS OD_province_type, "
    + "nullif(O_cell_state, '') AS O_cell_state, nullif(D_cell_state, '') AS D_cell_state) FROM ("
    + table_sql("province", phone="phone", home="home_province")
    + ")",
)
def _(t):
    roaming = R.read_roaming_extract(t.spark, roaming_file(t), clock=UTC)
    heard = t.signalling().where(F.col("msisdn").startswith("86"))
    table = O.od_roaming(heard, roaming, "province", t.by_phone())
    return written(t, table, kinds_of(table))


@query("place_labels_weekend_files", READ + weekend_sql("tsv", "CAST(NULL AS VARCHAR)"))
def _(t):
    rows = R.read_signalling_tsv(t.spark, signalling_file(t), clock=UTC)
    users = R.load_subscriber_dim(t.spark, subscriber_file(t))
    scenes = t.cells().select(
        F.col("eci").cast("string").alias("cell"), F.col("scene_name").alias("scene")
    )
    stays = rows.withColumn("code", F.col("eci").cast("string"))
    table = B.place_labels_weekend(stays, users, scenes, UTC)
    return written(t, table, kinds_of(table))
