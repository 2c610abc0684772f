"""Segmentation, smoothing and merging of stays."""

from pyspark.sql import functions as F

from testbed.registry import query
from testbed.sqlviews import CODE, aggregate, merge, project, runs, smooth
from waymarks.operators import stays as S
from waymarks.operators.ordered import DAILY, Timeline


def degrees(df):
    return df.withColumns({"lon": F.round("lon", 7), "lat": F.round("lat", 7)})


STAY = (
    "imsi, date, event_id, code, s_time, e_time, duration, round(lon,7) AS lon, "
    "round(lat,7) AS lat, scene, rat"
)
BY_END = "e_time, s_time, event_id"


@query(
    "segment_stays",
    f"SELECT imsi, date, event_id, code, CAST(g AS BIGINT) AS stay_no FROM {runs('pt')}",
)
def _(t):
    marked = S.segment_stays(t.points(), line=t.daily())
    numbered = marked.groupBy("imsi", "date", "run").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window

    nth = numbered.select(
        "imsi",
        "date",
        "run",
        F.row_number()
        .over(Window.partitionBy("imsi", "date").orderBy("run"))
        .cast("bigint")
        .alias("stay_no"),
    )
    return marked.join(nth, ["imsi", "date", "run"]).select(
        "imsi", "date", "event_id", "code", "stay_no"
    )


@query("stay_aggregate", f"SELECT {STAY}, points, source FROM {aggregate('pt')}")
def _(t):
    return degrees(S.stay_aggregate(t.points(), line=t.daily()))


@query(
    "stay_aggregate_given_center",
    f"""SELECT a.imsi, a.date, a.event_id, a.code, a.s_time, a.e_time, a.duration, a.points,
    a.scene, round(c.lon,7) AS lon, round(c.lat,7) AS lat
    FROM {aggregate('pt')} a LEFT JOIN cells c ON a.code = c.code AND c.code<>'0'""",
)
def _(t):
    return degrees(S.stay_aggregate_given_center(t.points(), t.cells(), line=t.daily()))


@query("stays_from_intervals", f"SELECT {STAY} FROM {merge('iv_county', order=BY_END)}")
def _(t):
    return degrees(S.stays_from_intervals(t.intervals("county"), line=t.daily()))


@query("merge_adjacent_stays", f"SELECT {STAY} FROM {merge('iv_county')}")
def _(t):
    return degrees(S.merge_adjacent_stays(t.intervals("county"), line=t.daily()))


@query("smooth_overlaps", f"SELECT * FROM {smooth('iv')}")
def _(t):
    return S.smooth_overlaps(t.intervals(), line=t.daily())
