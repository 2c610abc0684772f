"""Readers of files with bad lines, dimensions with contradictions, and joins of intervals and places."""

import pytest
from pyspark.sql import functions as F

from waymarks.functions.calendar import SHANGHAI, UTC
from waymarks.operators import clean, crowds, dims, flows, intervals
from waymarks.operators import stays as S
from waymarks.plans import jobs
from waymarks.sources import readers as R

H = 3_600_000


def lines(spark, tmp_path, rows, name="f"):
    path = str(tmp_path / name)
    spark.createDataFrame([(r,) for r in rows], "value string").write.text(path)
    return path


def test_signalling_lines_are_read_or_rejected(spark, tmp_path):
    good = "2020-09-09\t138\t25601\ti\tm\t2020-09-09 08:00:00\tx\t2020-09-09 08:10:00"
    bad = [
        good.replace("138", "unknow"),
        "2020-09-09\t138",
        "",
        good.replace("25601", "cell"),
        good.replace("08:10:00", "late"),
    ]
    path = lines(spark, tmp_path, [good, good, *bad])
    rows = R.read_signalling_tsv(spark, path).collect()
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0].event_id is not None
    assert rows[0].e_time - rows[0].s_time == 600_000
    told = {r.value: r.reason for r in R.read_signalling_tsv(spark, path, rejects=True).collect()}
    assert list(map(told.get, bad)) == [
        "missing data", "too few fields", "too few fields", "unreadable cell", "unreadable time",
    ]


def test_roaming_lines_are_read_or_rejected(spark, tmp_path):
    good = "d|138||2020-09-09 08:00:00|2020-09-09 09:00:00|86|China|China|P1||x|1|||P0|home|one"
    abroad = good.replace("|86|", "|66|")
    path = lines(spark, tmp_path, [good, abroad, "short|line", good.replace("09:00:00", "?"), ""])
    row = R.read_roaming_extract(spark, path).collect()
    assert [(r.date, r.phone, r.province_code, r.next_start) for r in row] == [("d", "138", "P1", None)]
    assert R.read_roaming_extract(spark, path, abroad=True).count() == 1
    reasons = sorted(r.reason for r in R.read_roaming_extract(spark, path, rejects=True).collect())
    assert reasons == ["no country", "no country", "unreadable time"]


def test_read_rows_feed_the_jobs(spark, tmp_path):
    def line(start, end, eci, imsi="i"):
        day = "2020-09-09"
        return f"{day}\t138\t{eci}\t{imsi}\tm\t{day} {start}:00\tx\t{day} {end}:00"

    path = lines(spark, tmp_path, [
        line("08:00", "08:10", 25601), line("08:20", "08:30", 25601), line("09:00", "09:10", 25602),
        line("10:00", "10:10", 999), line("08:00", "08:10", 25601, "bad"), line("09:00", "09:10", 25603, "bad"),
    ])
    rows = R.read_signalling_tsv(spark, path).withColumn("scene", F.lit("ROAD"))
    sites = spark.createDataFrame(
        [(25601, 105.0, 26.0), (25601, 105.0, 26.0), (25602, 105.1, 26.0), (25603, -1.0, 26.0)],
        "eci bigint, lon double, lat double",
    )
    counties = spark.createDataFrame([("25601", "C1")], "code string, county_id string")
    table = jobs.cell_stay_table_text(rows, sites, counties).orderBy("enter_time").collect()
    assert [(r.imsi, r.cell, r.county_code) for r in table] == [("i", "25601", "C1"), ("i", "25602", "")]
    counts = jobs.interval_trace_count(rows.where("imsi = 'i'"), sites).collect()
    assert [r.stays for r in counts] == [2]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([("2024-03-10 02:30:00",), ("never",), (None,)], "t string")
        got = [r[0] for r in df.select(UTC.parse(F.col("t"))).collect()]
        assert got == [1_710_037_800_000, None, None]
        assert df.select(SHANGHAI.parse(F.col("t"))).first()[0] == 1_710_037_800_000 - 8 * H
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_short_and_blank_fields_are_null(spark):
    df = spark.createDataFrame(
        [("short,line",), ("",), ("i,1,2,,5,,ROAD,x,15,25",), ("i,1,2,,5,7,ROAD,1,15,25",)], "value string"
    )
    rows = clean.parse_location_csv(df).collect()
    assert [r.s_time for r in rows] == [None, None, 1, 1] and rows[2].session is None
    events = clean.expand_source_target_cell(df).collect()
    assert [r.role for r in events] == ["source"] * 4 + ["target"] and events[-1].eci == 7
    cells = spark.createDataFrame([("99999999999999_1",), ("x_1",), ("5_7",), ("7_",), (None,)], "cell string")
    assert [r.cell_number for r in clean.normalise_cell_id(cells).collect()] == [0, 0, 500_007, 0, 0]


def test_cells_are_unique_for_joins(spark, tmp_path):
    path = lines(spark, tmp_path, [
        "s|n|25601|T1|t|C1|c", "s|n|25601|T1|t|C2|c", "s|n|oops|T1|t|C3|c", "s|n|1_2|T1|t|C4|c", "short",
        "s|n|1-2|T1|t|C5|c",
    ])
    area = R.load_area_dim(spark, path)
    assert sorted(r.code for r in area.collect()) == ["100002", "25601", "25601"]
    reasons = sorted(r.reason for r in R.load_area_dim(spark, path, rejects=True).collect())
    assert reasons == ["marked with -", "too few fields", "unreadable cell"]
    cells = area.select("code", "rat", "county_id")
    assert {r.county_id for r in dims.one_row_per_cell(cells).collect()} == {"C1", "C4"}
    found = dims.cell_conflicts(cells).collect()
    assert [(r.code, r.rows, r.kept.county_id, r.other.county_id) for r in found] == [("25601", 2, "C1", "C2")]
    # A 2G and a 4G cell with one code, an unreadable one, and a repeated one.
    stays = spark.createDataFrame(
        [("u", "d", i, c, rat, i * H, i * H + 1000, 1.0, 1.0, "ROAD") for i, (c, rat) in enumerate(
            [("9", 2), ("9", 6), ("0", 6), ("8", 6)])],
        "imsi string, date string, event_id long, code string, rat int, s_time long, e_time long, lon double, "
        "lat double, scene string",
    )
    areas = spark.createDataFrame(
        [("9", 2, "two"), ("9", 6, "four"), ("0", 6, "none"), ("8", 6, "b"), ("8", 6, "a")],
        "code string, rat int, area_code string",
    )
    merged = S.relabel_and_remerge(stays, areas).orderBy("s_time").collect()
    assert [r.code for r in merged] == ["two", "four", "", "a"]


def test_a_newcomer_is_added_once(spark):
    crowd = spark.createDataFrame([("a", 1), ("b", 2)], "imsi string, age int")
    new = spark.createDataFrame([("b", 9), ("b", 7), ("c", 3), ("c", 3)], "imsi string, age int")
    assert sorted(map(tuple, crowds.crowd_add_users(crowd, new).collect())) == [("a", 1), ("b", 9), ("c", 3)]
    assert crowds.crowd_is_empty(crowd.where("age > 9")).first()[0] and crowds.crowd_non_empty(crowd).first()[0]


def test_overlap_join_equals_all_pairs(spark):
    import random

    rng = random.Random(4)
    a = [(i, rng.choice("xy"), s := rng.randint(0, 50) * 1000, s + rng.choice([0, 500, 7000, 90_000])) for i in range(60)]
    b = [(i, rng.choice("xy"), s := rng.randint(0, 50) * 1000, s + rng.choice([1, 1000, 30_000])) for i in range(40)]
    a += [(100, "x", None, 5), (101, "x", 9000, 3000), (102, "x", 0, 9 * 10**15)]
    left = spark.createDataFrame(a, "l long, k string, s long, e long")
    right = spark.createDataFrame(b, "r long, k string, f long, u long")
    got = intervals.overlap_join(left, right, ("s", "e"), ("f", "u"), ("k",), bucket_ms=3000)
    want = sorted((x[0], y[0]) for x in a[:60] for y in b if x[1] == y[1] and x[2] < y[3] and x[3] > y[2])
    assert sorted((r.l, r.r) for r in got.collect()) == want
    broken = {r.l: r.reason for r in intervals.broken_intervals(left, "s", "e").collect()}
    assert broken == {100: "no time", 101: "ends before it starts", 102: "too long"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_radius_join_equals_all_pairs(spark):
    from waymarks.functions import geo

    spots = [(105 + i * 0.01, 26 + (i * 7 % 13) * 0.01) for i in range(40)]
    spots += [(179.999, 10.0), (-179.999, 10.0), (105.0, 89.9), (15.0, 89.9), (105.0, -89.9)]
    cells = spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "eci long, lon double, lat double")
    places = spark.createDataFrame([(f"p{i}", *s) for i, s in enumerate(spots[::3])], "place string, lon double, lat double")
    for radius in (900.0, 5000.0, 60_000.0):
        got = clean.cells_near_places(cells, places, radius)
        xy = {r.eci: (r.x, r.y) for r in geo.with_metres(cells).collect()}
        at = {r.place: (r.x, r.y) for r in geo.with_metres(places).collect()}
        want = {
            (p, c) for p, (px, py) in at.items() for c, (x, y) in xy.items()
            if ((x - px) ** 2 + (y - py) ** 2) ** 0.5 < radius
        }
        pairs = [(r.place, r.eci) for r in got.collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_stay_that_never_ends_is_a_reject(spark):
    rows = spark.createDataFrame(
        [("u", "A", 0, 4 * H), ("u", "A", H, 5 * H), ("v", "A", 0, 9 * 10**15), ("w", "A", None, 5), (None, "A", 0, 3 * H)],
        "imsi string, code string, s_time long, e_time long",
    )
    plain = {r.hour_stamp[9:11]: tuple(r)[2:] for r in flows.hourly_flow_of_areas(rows, UTC).collect()}
    assert plain == {
        "00": (2, 0, 2, 0), "01": (3, 2, 1, 0), "02": (3, 3, 0, 0), "03": (1, 2, 0, 1), "04": (0, 1, 0, 1),
        "05": (-1, 0, 0, 1),
    }
    one = {r.hour_stamp[9:11]: tuple(r)[2:] for r in flows.hourly_flow_of_areas(rows, UTC, distinct=True).collect()}
    assert one == {
        "00": (1, 0, 1, 0), "01": (2, 1, 1, 0), "02": (1, 1, 0, 0), "03": (1, 1, 0, 0), "04": (0, 1, 0, 1),
        "05": (-1, 0, 0, 1),
    }
    assert sorted(r.reason for r in flows.flow_rejects(rows).collect()) == ["no time", "too long"]


def test_days_are_appended_and_only_touching_stays_merge(spark):
    def row(day, code, a, b, i):
        return ("u", day, i, code, a * H, b * H, (b - a) * H, 105.0 + i, 26.0, "ROAD")

    df = spark.createDataFrame(
        [row("1", "A", 0, 1, 0), row("1", "A", 2, 3, 1), row("1", "B", 4, 5, 2),
         row("2", "B", 30, 31, 3), row("3", "B", 50, 51, 4), row("3", "C", 52, 60, 5),
         row("4", "C", 55, 70, 6), row("5", "C", 80, 81, 7), row("5", "C", 82, 83, 8)],
        "imsi string, date string, event_id long, code string, s_time long, e_time long, duration long, "
        "lon double, lat double, scene string",
    )
    got = [(r.code, r.s_time // H, r.e_time // H, r.event_id) for r in S.append_traces(df).orderBy("s_time").collect()]
    # Day 4 overlaps day 3 and is left out; A, A and the last C, C lie inside their days and stay apart.
    assert got == [("A", 0, 1, 0), ("A", 2, 3, 1), ("B", 4, 51, 2), ("C", 52, 81, 5), ("C", 82, 83, 8)]
