"""Normalisation, decoding and filtering of raw rows."""

from pyspark.sql import functions as F

from testbed.registry import query
from testbed.sqlviews import MIDNIGHT
from waymarks.functions.calendar import UTC, calendar_enrich
from waymarks.operators import clean


@query("classify_source", "SELECT event_id, loc_type, source FROM pt")
def _(t):
    raw = t.points().drop("source")
    return clean.classify_source(raw).select("event_id", "loc_type", "source")


@query("filter_location_type", "SELECT event_id, loc_type FROM pt WHERE loc_type IN ('5','6')")
def _(t):
    return clean.filter_location_type(t.points()).select("event_id", "loc_type")


@query("classify_rat", "SELECT event_id, cell, CAST(rat AS INTEGER) AS rat FROM pt")
def _(t):
    return clean.classify_rat(t.points().drop("rat")).select("event_id", "cell", "rat")


@query(
    "normalise_cell_id",
    "SELECT event_id, cell, CAST(code AS BIGINT) AS cell_number FROM pt",
)
def _(t):
    return clean.normalise_cell_id(t.points()).select("event_id", "cell", "cell_number")


VOICE = """CASE WHEN ci<=65535 THEN concat(lac, '-', ci) ELSE CAST(ci AS VARCHAR) END"""


@query(
    "decode_voice_cell",
    f"SELECT event_id, {VOICE} AS code FROM tick WHERE service='voice'",
)
def _(t):
    voice = t.tickets().where(F.col("service") == "voice")
    return clean.ticket_stays(voice, "voice", UTC).select("event_id", "code")


@query(
    "decode_data_cell",
    "SELECT event_id, CAST(lac*256 + ci AS VARCHAR) AS code FROM tick WHERE service='data'",
)
def _(t):
    data = t.tickets().where(F.col("service") == "data")
    bare = data.withColumn("cell", F.substring_index("cell", "|", 1))
    return clean.ticket_stays(bare, "data", UTC).select("event_id", "code")


@query(
    "ticket_interval",
    "SELECT event_id, s_time, s_time + seconds*1000 AS e_time FROM tick",
)
def _(t):
    return clean.ticket_interval(t.tickets(), UTC).select("event_id", "s_time", "e_time")


@query("site_of_cell", "SELECT event_id, eci//256 AS site FROM pt")
def _(t):
    return clean.site_of_cell(t.points()).select("event_id", "site")


def csv_lines(t):
    """Location lines: field 5 is a target cell, or the number that stands for none."""
    p = t.points()
    target = F.when(F.col("k") % 3 == 0, "4294967295").otherwise(
        (F.col("eci") + 256).cast("string")
    )
    fields = [
        "imsi", "s_time", F.col("s_time") + 1000, F.lit(""), "eci", target, "scene", "k",
        "lon", "lat",
    ]
    text = [(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]
    return p.select(F.concat_ws(",", *text).alias("value"))


@query(
    "parse_location_csv",
    """SELECT imsi, s_time, s_time+1000 AS e_time, eci, scene, k AS session,
    round(lon,7) AS lon, round(lat,7) AS lat FROM pt""",
)
def _(t):
    return clean.parse_location_csv(csv_lines(t)).withColumns(
        {"lon": F.round("lon", 7), "lat": F.round("lat", 7)}
    )


@query(
    "expand_source_target_cell",
    """SELECT imsi, scene, k AS session, 'source' AS role, s_time, s_time+1000 AS e_time, eci,
      round(lon,7) AS lon, round(lat,7) AS lat FROM pt
    UNION ALL SELECT imsi, scene, k, 'target', s_time+1000, s_time+1000, eci+256, NULL, NULL
    FROM pt WHERE k%3<>0""",
)
def _(t):
    return clean.expand_source_target_cell(csv_lines(t)).withColumns(
        {"lon": F.round("lon", 7), "lat": F.round("lat", 7)}
    )


@query(
    "place_code",
    "SELECT event_id, concat('C', k//10) AS aoi, CAST(eci AS VARCHAR) AS sector FROM pt",
)
def _(t):
    p = t.points().withColumn("aoi_code", F.concat(F.lit("C"), F.floor(F.col("k") / 10)))
    aoi = clean.place_code(p, "AOI").withColumn("aoi", F.col("code"))
    return clean.place_code(aoi, "SECTOR").select("event_id", "aoi", F.col("code").alias("sector"))


@query(
    "guard_day",
    f"""SELECT event_id, date FROM iv WHERE imsi<>'' AND e_time - {MIDNIGHT} < 86400000""",
)
def _(t):
    ends = t.intervals().withColumn("s_time", F.col("e_time"))
    return clean.guard_day(ends, F.col("date"), UTC).select("event_id", "date")


@query(
    "drop_bad_coordinate_traces",
    """, p AS (SELECT *, CASE WHEN value<3 THEN -1e0 ELSE lon END AS l FROM pt)
    SELECT event_id FROM p WHERE (imsi, date) NOT IN
      (SELECT (imsi, date) FROM p WHERE l<0 OR l>180 OR lat<0 OR lat>180)""",
)
def _(t):
    p = t.points().withColumn("lon", F.when(F.col("value") < 3, -1.0).otherwise(F.col("lon")))
    return clean.drop_bad_coordinate_traces(p).select("event_id")


@query(
    "require_full_identity",
    """SELECT event_id FROM (SELECT *, CASE WHEN k%5=0 THEN '' ELSE concat('138', imsi) END AS phone,
      CASE WHEN k%7=0 THEN NULL ELSE concat('86', imsi) END AS imei FROM pt)
    WHERE phone<>'' AND imei IS NOT NULL""",
)
def _(t):
    k = F.col("k")
    p = t.points().withColumns(
        {
            "phone": F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("138"), "imsi")),
            "imei": F.when(k % 7 != 0, F.concat(F.lit("86"), "imsi")),
        }
    )
    return clean.require_full_identity(p).select("event_id")


@query(
    "null_to_empty",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, imsi,
    CASE WHEN k%5=0 THEN '' ELSE CAST(k AS VARCHAR) END AS k FROM pt""",
)
def _(t):
    p = t.points().select("event_id", "imsi", F.when(F.col("k") % 5 != 0, F.col("k")).alias("k"))
    return clean.to_string_row(p)


@query(
    "keep_cells_in_dim",
    """SELECT event_id, code FROM pt WHERE (code, rat) IN
    (SELECT (code, rat) FROM cells WHERE scene_id IN ('YDY2','YDY3'))""",
)
def _(t):
    return clean.keep_cells_in_dim(t.points(), t.hubs(), ["code", "rat"]).select(
        "event_id", "code"
    )


@query(
    "calendar_enrich",
    """, c AS (SELECT event_id, s_time, make_timestamp(s_time*1000) AS x FROM pt)
    SELECT event_id, s_time, CAST(hour(x) AS INTEGER) AS hour, CAST(minute(x) AS INTEGER) AS minute,
      CAST(second(x) AS INTEGER) AS second, CAST(isodow(x) AS INTEGER) AS weekday,
      isodow(x)>=6 AS rest_day, strftime(x, '%Y%m%d') AS day_compact,
      strftime(x, '%Y-%m-%d %H:%M') AS minute_label, strftime(x, '%Y%m%d %H:00:00') AS hour_label,
      concat(strftime(x, '%H'), '-', lpad(CAST(hour(x)+1 AS VARCHAR), 2, '0')) AS hour_range
    FROM c""",
)
def _(t):
    return calendar_enrich(t.points().select("event_id", "s_time"), UTC)
