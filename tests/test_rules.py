"""Rules of places, labels, OD changes and flows on small hand-worked inputs."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from waymarks.functions.calendar import UTC
from waymarks.operators import crowds as G
from waymarks.operators import flows as L
from waymarks.operators import labels as B
from waymarks.operators import od as O
from waymarks.operators import places as P
from waymarks.operators.ordered import DAILY
from waymarks.plans import jobs as J
from waymarks.sources import writers as W

H = 3_600_000
DAY0 = 1_599_609_600_000  # 2020-09-09 00:00 UTC
LINES = [replace(DAILY, slice_ms=10**15), replace(DAILY, slice_ms=H), DAILY]


def stays(spark, rows):
    """(imsi, code, start hour, end hour) on 2020-09-09."""
    data = [
        (u, "2020-09-09", i, c, int(DAY0 + a * H), int(DAY0 + b * H), int((b - a) * H), 105.0, 26.0 + i, "ROAD", 6)
        for i, (u, c, a, b) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data,
        "imsi string, date string, event_id long, code string, s_time long, e_time long, "
        "duration long, lon double, lat double, scene string, rat int",
    )


def test_work_place_needs_more_than_the_minimum_days(spark):
    df = stays(spark, [("u", "1111", 1, 8), ("u", "1114", 10, 13), ("u", "1114", 14, 16)])
    found = P.work_place(df, min_days=0, clock=UTC).collect()
    assert [(r["code"], r["days"]) for r in found] == [("1114", 1)]
    assert P.work_place(df, min_days=1, clock=UTC).count() == 0
    assert P.live_place(df, min_days=0, clock=UTC).first()["code"] == "1111"


def test_stay_kinds(spark):
    df = stays(
        spark,
        [("u", "home", 20, 24), ("u", "office", 9, 16), ("u", "shop", 17, 18), ("u", "street", 19, 19.2)],
    )
    kinds = {r["code"]: r["kind"] for r in P.stay_kind(df, UTC).collect()}
    assert kinds == {"home": "LIVE", "office": "WORK", "shop": "LINGER", "street": "PASSBY"}


@pytest.mark.parametrize("line", LINES)
def test_hourly_flow_of_one_area(spark, line):
    cells = spark.createDataFrame(
        [("a", "C1", "one", "T"), ("b", "C1", "one", "T"), ("c", "C2", "two", "T")],
        "code string, county_id string, county_name string, city_id string",
    )
    df = stays(spark, [("u", "a", 8.5, 9.5), ("u", "b", 9.2, 11.5), ("u", "c", 12, 12.5)])
    flow = {
        (r["hour_stamp"][9:11], r["code"]): (r["stay_count"], r["in_count"], r["out_count"], r["total"])
        for r in L.hourly_area_flow(df, cells, line, UTC).collect()
    }
    assert flow == {
        ("08", "C1"): (0, 1, 0, 1),
        ("09", "C1"): (1, 0, 0, 1),
        ("10", "C1"): (1, 0, 0, 1),
        ("11", "C1"): (0, 0, 1, -1),
        ("12", "C2"): (0, 1, 1, 0),
    }


def placed(spark, places):
    df = stays(spark, [("u", f"cell{i}", i, i + 0.5) for i in range(len(places))])
    by_id = F.create_map(*[v for i, p in enumerate(places) for v in (F.lit(i), F.lit(p))])
    return df.withColumn("place_code", by_id[F.col("event_id").cast("int")]).withColumns(
        {"place_name": F.col("place_code"), "place_scene": F.lit("")}
    )


def pairs(changes):
    return [
        (r["o"]["place_code"], r["d"]["place_code"])
        for r in changes.orderBy("s_time").collect()
    ]


@pytest.mark.parametrize("line", LINES)
def test_od_changes(spark, line):
    df = placed(spark, ["", "A", "A", "B", "", "B", "C"])
    assert pairs(O.od_changes(df, line)) == [("", "A"), ("A", "B"), ("B", ""), ("", "B"), ("B", "C")]
    assert pairs(O.od_changes(df, line, skip_blank=True)) == [("A", "B"), ("B", "C")]
    # Row-position rule: rows 1, 2 and the last pair with themselves.
    assert pairs(O.od_changes(df, line, compat=True)) == [
        ("A", "A"), ("A", "B"), ("B", ""), ("", "B"), ("C", "C"),
    ]


def users(spark):
    data = [
        ("teacher_by_income", "s1", "s1", "s1", 40, 500.0),
        ("poor_neighbour", "s1", "s1", "s1", 40, 50.0),
        ("teacher_by_holiday", "h9", "s1", "s2", 40, 0.0),
        ("student", "s1", "s2", "x", 20, 0.0),
        ("doctor", "256", "512", "1024", 40, 0.0),
        ("trader", "256", "768", "x", 40, 5000.0),
    ]
    return spark.createDataFrame(
        data, "imsi string, home_cell string, work_cell string, holiday_cell string, age int, income double"
    ).withColumns({"phone": F.lit(""), "imei": F.lit("")})


def test_place_labels(spark):
    areas = spark.createDataFrame(
        [("s1", "school", "one"), ("s2", "school", "two"), ("512", "hospital", "big"), ("768", "business", "mall")],
        "cell string, kind string, name string",
    )
    got = {(r["imsi"], r["crowd_name"]) for r in B.place_labels(users(spark), areas, 100, 1000).collect()}
    assert got == {
        ("teacher_by_income", B.EDUCATOR), ("teacher_by_holiday", B.EDUCATOR),
        ("student", B.STUDENT), ("doctor", B.DOCTOR), ("trader", B.BUSINESS),
    }


def test_driver_cut_offs_are_strict(spark):
    df = stays(spark, [("u", "a", 1, 2), ("u", "b", 3, 4), ("u", "a", 5, 6), ("v", "a", 1, 2), ("v", "b", 2, 3)])
    got = {r["imsi"]: r["crowd_name"] for r in B.driver_labels_by_revisit(df, 1, 0.5, 1).collect()}
    assert got == {"v": B.TAXI}


def test_crowd_rules(spark):
    crowd = spark.createDataFrame([("a", 1), ("b", 2)], "imsi string, age int")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "imsi string, age int")
    assert sorted(tuple(r) for r in G.crowd_add_users(crowd, new).collect()) == [("a", 1), ("b", 9), ("c", 3)]
    assert G.head_density(crowd, 0).first()["density"] == float("inf")
    nobody = crowd.where("age > 5").withColumn("gender", F.lit("Male"))
    assert tuple(G.gender_insight(nobody).first()) == (0, 0, 0.0, 0.0)


def test_secondary_sort_reads_bad_scores_as_zero(spark):
    df = spark.createDataFrame([("g1", "a", "70"), ("g1", "b", "bad"), ("g1", "c", "90"), ("g0", "d", "1")], "g string, s string, score string")
    rows = [(r["g"], r["s"], r["score"]) for r in J.secondary_sort(df, "g", "score").collect()]
    assert rows == [("g0", "d", 1), ("g1", "c", 90), ("g1", "a", 70), ("g1", "b", 0)]


def test_partition_overwrite(spark, tmp_path):
    df = spark.range(100).withColumn("day_id", (F.col("id") % 3).cast("string"))
    path = str(tmp_path / "days")
    W.write_partition_overwrite(df, path)
    W.write_partition_overwrite(df.where("day_id = '1' and id < 5"), path)
    left = spark.read.parquet(path)
    assert left.where("day_id = 1").count() == 2 and left.count() == 67 + 2
