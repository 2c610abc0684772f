"""Readers and writers, over files that Spark derives from the given tables."""

from pyspark.sql import functions as F

from testbed.registry import query
from testbed.sqlviews import ECI, MS
from waymarks.functions.calendar import UTC
from waymarks.sources import readers as R
from waymarks.sources import writers as W


def written_points(t):
    """Points as a table partitioned by day, with the hour as a column."""
    p = t.points().select(
        "imsi", "event_id", "loc_type", "s_time", "cell", "lon", "lat", F.col("date").alias("day_id"),
        F.lpad(UTC.hour(F.col("s_time")).cast("string"), 2, "0").alias("hour"),
    )
    path = t.scratch("points")
    W.write_partition_overwrite(p, path)
    return t.spark.read.schema(
        "imsi string, event_id bigint, loc_type string, s_time bigint, cell string, lon double, "
        "lat double, hour string, day_id string"
    ).parquet(path)


@query(
    "read_partition",
    """SELECT imsi, event_id, s_time, cell FROM pt WHERE date='2024-01-10'
    AND (s_time//3600000)%24=9""",
)
def _(t):
    return R.read_partition(
        written_points(t), ["imsi", "event_id", "s_time", "cell"], "2024-01-10", "09"
    )


@query(
    "read_partition_prefix",
    "SELECT event_id, msisdn, stat_hour FROM sig WHERE stat_hour LIKE '20240110%' AND msisdn NOT LIKE '86%'",
)
def _(t):
    rows = R.read_partition_prefix(t.signalling(), "20240110", "86", exclude=True)
    return rows.select("event_id", "msisdn", "stat_hour")


def tsv_lines(t):
    """Signalling text; some lines hold a missing-data marker, some are short."""
    e = t.intervals("eci")
    start, end = UTC.second_label(F.col("s_time")), UTC.second_label(F.col("e_time"))
    imei = F.when(F.col("event_id") % 11 == 0, "unknow").when(
        F.col("event_id") % 13 == 0, "\\N"
    ).otherwise(F.concat(F.lit("86"), "imsi"))
    whole = F.concat_ws(
        "\t", "date", F.concat(F.lit("138"), "imsi"), "code", "imsi", imei, start, F.lit("x"), end
    )
    short = F.concat_ws("\t", "date", F.concat(F.lit("138"), "imsi"), "code", "imsi", imei)
    return e.select(F.when(F.col("event_id") % 17 == 0, short).otherwise(whole).alias("value"), "date")


TSV = f"""SELECT date, concat('138', imsi) AS phone, {ECI} AS eci, imsi, concat('86', imsi) AS imei,
    s_time//1000*1000 AS s_time, (s_time+{MS})//1000*1000 AS e_time FROM ev
  WHERE event_id%11<>0 AND event_id%13<>0 AND event_id%17<>0"""


def signalling_file(t):
    path = t.scratch("signalling")
    tsv_lines(t).select("value").write.text(path)
    return path


@query("read_signalling_tsv", TSV)
def _(t):
    return R.read_signalling_tsv(t.spark, signalling_file(t), clock=UTC).drop("event_id")


@query(
    "read_signalling_tsv_rejects",
    """SELECT reason, count(*) AS lines FROM (SELECT CASE WHEN event_id%17=0 THEN
      CASE WHEN event_id%11=0 OR event_id%13=0 THEN 'missing data' ELSE 'too few fields' END
      WHEN event_id%11=0 OR event_id%13=0 THEN 'missing data' END AS reason FROM ev)
    WHERE reason IS NOT NULL GROUP BY reason""",
)
def _(t):
    bad = R.read_signalling_tsv(t.spark, signalling_file(t), clock=UTC, rejects=True)
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


@query("read_multi_day", TSV + " AND date LIKE '2024-01-0%'")
def _(t):
    path = t.scratch("days")
    lines = tsv_lines(t).withColumn("day", F.regexp_replace("date", "-", ""))
    lines.select("value", "day").hint("rebalance", "day").write.partitionBy("day").text(path)
    return R.read_multi_day(t.spark, f"{path}/day=2024010[1-9]/", clock=UTC).drop("event_id")


@query(
    "read_roaming_extract",
    """SELECT date, phone, country_code, country_name, country_name_en, province_code, 'g' AS gap,
    home_province_code, home_province_name, province_name, s_time//1000*1000 AS s_time,
    e_time//1000*1000 AS e_time, CAST(NULL AS BIGINT) AS next_start FROM roam
    WHERE country_code='86' AND province_code<>''""",
)
def _(t):
    return R.read_roaming_extract(t.spark, roaming_file(t), clock=UTC).drop("event_id")


def roaming_file(t):
    r = t.roaming()
    blank = F.lit("")
    line = F.concat_ws(
        "|", "date", "phone", blank, UTC.second_label(F.col("s_time")),
        UTC.second_label(F.col("e_time")), "country_code", "country_name", "country_name_en",
        "province_code", blank, blank, F.lit("g"), blank, blank, "home_province_code",
        "home_province_name", "province_name",
    )
    path = t.scratch("roaming")
    r.select(line.alias("value")).write.text(path)
    return path


def area_file(t):
    path = t.scratch("area")
    c = t.cells()
    bad = F.when(F.col("k") % 9 == 0, "-").otherwise("")
    line = F.concat_ws(
        "|", "scene_id", "scene_name", "cell", "city_id", "city_name", "county_id",
        F.concat("county_name", bad),
    )
    c.select(line.alias("value")).write.text(path)
    return path


AREA = """SELECT scene_id, scene_name, cell, city_id, city_name, county_id, county_name,
    CAST(rat AS INTEGER) AS rat, code FROM cells WHERE k%9<>0"""


@query("load_area_dim", AREA)
def _(t):
    return R.load_area_dim(t.spark, area_file(t))


@query("filter_area_dim_by_scene", AREA + " AND (scene_id IN ('YDY2') OR scene_name IN ('学校'))")
def _(t):
    return R.filter_area_dim_by_scene(R.load_area_dim(t.spark, area_file(t)), ("YDY2",), ("学校",))


@query("load_cell_sites", "SELECT eci, round(lon,6) AS lon, round(lat,6) AS lat FROM cells")
def _(t):
    path = t.scratch("sites")
    t.cells().select("eci", "lon", "lat").write.csv(path)
    sites = R.load_cell_sites(t.spark, path)
    return sites.select("eci", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


def subscriber_file(t):
    path = t.scratch("subscribers")
    line = F.concat_ws(
        "|", F.lit("d"), "phone", "imsi", "age", "income", "home_cell", F.lit(""), "work_cell"
    )
    t.subscribers().select(line.alias("value")).write.text(path)
    return path


@query(
    "load_subscriber_dim",
    """SELECT phone, imsi, CAST(NULL AS VARCHAR) AS imei, age, income, home_cell, work_cell
    FROM subs""",
)
def _(t):
    return R.load_subscriber_dim(t.spark, subscriber_file(t))


@query(
    "write_partition_overwrite",
    """SELECT event_id, date AS day_id, CASE WHEN date='2024-01-10' THEN 'new' ELSE 'old' END AS version
    FROM ev""",
)
def _(t):
    rows = t.points().select("event_id", F.col("date").alias("day_id"), F.lit("old").alias("version"))
    path = t.scratch("overwrite")
    W.write_partition_overwrite(rows, path)
    again = rows.where(F.col("day_id") == "2024-01-10").withColumn("version", F.lit("new"))
    W.write_partition_overwrite(again, path)
    return t.spark.read.schema("event_id bigint, version string, day_id string").parquet(path)


@query(
    "write_text_replace",
    """SELECT concat(imsi, chr(9), event_id, chr(9), CASE WHEN k%5=0 THEN '' ELSE CAST(k AS VARCHAR) END)
    AS value FROM pt""",
)
def _(t):
    rows = t.points().select(
        "imsi", "event_id", F.when(F.col("k") % 5 != 0, F.col("k")).alias("k")
    )
    path = t.scratch("text")
    W.write_text_replace(rows.where(F.col("k") == 1), path)
    W.write_text_replace(rows, path)
    return t.spark.read.text(path)


@query("extract_subscriber_rows", "SELECT phone, event_id, code FROM (SELECT *, concat('138', imsi) AS phone FROM iv) WHERE phone='1387'")
def _(t):
    rows = t.intervals().withColumn("phone", F.concat(F.lit("138"), "imsi"))
    return R.extract_subscriber_rows(rows, "1387").select("phone", "event_id", "code")


@query(
    "load_district_dim",
    """SELECT cell, city_name, county_name, CAST(rat AS INTEGER) AS rat, code FROM cells
    WHERE code<>'0' AND k%9<>0""",
)
def _(t):
    short = F.when(F.col("k") % 9 == 0, F.lit(None)).otherwise(F.col("county_name"))
    blank = F.lit("x")
    line = F.concat_ws("\t", "cell", *[blank] * 5, "city_name", short)
    path = t.scratch("districts")
    t.cells().select(line.alias("value")).write.text(path)
    return R.load_district_dim(t.spark, path)


@query(
    "load_custom_area",
    "SELECT code, CAST(rat AS INTEGER) AS rat, 'station' AS area_code FROM cells WHERE code<>'0' AND k%10=0",
)
def _(t):
    path = t.scratch("custom")
    chosen = t.cells().where(F.col("k") % 10 == 0)
    chosen.select(F.concat_ws(",", F.lit("no"), "cell").alias("value")).write.text(path)
    return R.load_custom_area(t.spark, path, "station")


@query(
    "load_user_places",
    "SELECT phone, imsi, imei, work_cell, home_cell, holiday_cell, age, income FROM subs",
)
def _(t):
    """Places and age and income from two files, joined by phone."""
    blank = F.lit("")
    places, incomes = t.scratch("places"), t.scratch("incomes")
    users = t.subscribers()
    users.select(
        F.concat_ws(
            "\t", "phone", "imsi", "imei", *[blank] * 6, "work_cell", *[blank] * 4, "home_cell",
            *[blank] * 4, "holiday_cell",
        ).alias("value")
    ).write.text(places)
    users.select(F.concat_ws("\t", "phone", "imsi", "imei", "age", "income").alias("value")).write.text(incomes)
    return R.with_age_income(R.load_user_places(t.spark, places), R.load_age_income(t.spark, incomes))


@query(
    "cell_conflicts",
    """SELECT code, CAST(rat AS INTEGER) AS rat, CAST(2 AS BIGINT) AS rows, county_id AS kept, 'X' AS other
    FROM cells WHERE code<>'0' AND k%3=0""",
)
def _(t):
    from waymarks.operators.dims import cell_conflicts

    dim = t.cells().select("code", "rat", "county_id")
    again = t.cells().where(F.col("k") % 3 == 0).select("code", "rat", F.lit("X").alias("county_id"))
    found = cell_conflicts(dim.unionByName(again))
    return found.select(
        "code", "rat", "rows", F.col("kept.county_id").alias("kept"), F.col("other.county_id").alias("other")
    )
