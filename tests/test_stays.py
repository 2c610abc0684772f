"""Stays on hand-worked fixtures and against plain Python folds."""

import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from waymarks.operators import stays as S
from waymarks.operators import traces as E
from waymarks.operators.ordered import DAILY, Timeline

WHOLE = replace(DAILY, slice_ms=10**15)
SLICED = replace(DAILY, slice_ms=3_600_000)

AOI_EVENTS = [
    (1599617105000, 11.0, 21.0, "aoaCode3"),
    (1599624306000, 12.0, 22.0, "aoaCode3"),
    (1599627906000, 13.0, 23.0, "aoaCode3"),
    (1599635106000, 13.0, 23.0, "aoaCode4"),
    (1599649505000, 13.0, 23.0, "aoaCode1"),
]


def points(spark):
    data = [
        ("u", "2020-09-09", i, t, lon, lat, code, "INDOOR", 6, None)
        for i, (t, lon, lat, code) in enumerate(AOI_EVENTS)
    ]
    return spark.createDataFrame(
        data,
        "imsi string, date string, event_id long, s_time long, lon double, lat double, "
        "code string, scene string, rat int, source string",
    )


def interval_frame(spark, data):
    return spark.createDataFrame(
        data,
        "imsi string, date string, event_id long, code string, s_time long, e_time long, "
        "lon double, lat double, scene string",
    )


@pytest.mark.parametrize("line", [WHOLE, SLICED])
def test_one_day_of_aoi_events(spark, line):
    stays = S.stay_aggregate(points(spark), line)
    got = [
        (r["code"], r["s_time"], r["e_time"], r["duration"])
        for r in stays.orderBy("s_time").collect()
    ]
    assert got == [
        ("aoaCode3", 1599617105000, 1599627906000, 10801000),
        ("aoaCode4", 1599635106000, 1599635106000, 0),
        ("aoaCode1", 1599649505000, 1599649505000, 0),
    ]
    assert E.trace_contains(stays, "aoaCode1").first()["visited"]
    assert not S.traces_on_road(stays).first()["on_road"]
    assert E.trace_cost_time(stays, line).first()["cost_ms"] == 21599000
    assert stays.first()["source"] == "|"


@pytest.mark.parametrize("line", [replace(WHOLE, keys=("imsi",)), Timeline(keys=("imsi",))])
def test_merge_with_an_earlier_trace(spark, line):
    later = S.stay_aggregate(points(spark), WHOLE).select(
        "imsi", "date", "event_id", "code", "s_time", "e_time", "lon", "lat", "scene"
    )
    earlier = interval_frame(
        spark,
        [
            ("u", "2020-09-08", 100, "aoaCode1", 1599595505000, 1599599105000, 1.0, 1.0, "ROAD"),
            ("u", "2020-09-08", 101, "aoaCode5", 1599606305000, 1599613505000, 1.0, 1.0, "ROAD"),
        ],
    )
    for left, right in ((later, earlier), (earlier, later)):
        merged = S.merge_traces_across_days(left, right, line).orderBy("s_time").collect()
        assert [r["code"] for r in merged] == [
            "aoaCode1", "aoaCode5", "aoaCode3", "aoaCode4", "aoaCode1",
        ]
    overlapping = earlier.withColumn("e_time", F.lit(1599620000000))
    kept = S.merge_traces_across_days(later, overlapping, line)
    assert kept.count() == 3


@pytest.mark.parametrize("line", [WHOLE, SLICED])
def test_merge_of_two_stays(spark, line):
    two = interval_frame(
        spark,
        [
            ("u", "d", 1, "1111", 1000, 3000, 112.0, 42.0, "INDOOR"),
            ("u", "d", 2, "1111", 2000, 5000, 114.0, 42.0, "ROAD"),
        ],
    )
    row = S.merge_adjacent_stays(two, line).collect()[0]
    assert (row["s_time"], row["e_time"], row["duration"], row["scene"]) == (
        1000, 5000, 4000, "INDOOR",
    )
    assert row["lon"] == pytest.approx(113, abs=0.01)


def test_merge_equals_stepwise_midpoints(spark):
    rng = random.Random(3)
    data = [
        ("u", "d", i, rng.choice("AAAB"), i * 1_700_000, i * 1_700_000 + 5000,
         105 + rng.random(), 26 + rng.random(), rng.choice(["INDOOR", "ROAD"]))
        for i in range(40)
    ]
    df = interval_frame(spark, data)
    plain = S.merge_adjacent_stays(df, WHOLE).orderBy("s_time").collect()
    for line in (SLICED, replace(DAILY, slice_ms=1)):
        cut = S.merge_adjacent_stays(df, line).orderBy("s_time").collect()
        assert len(cut) == len(plain)
        for a, b in zip(plain, cut):
            assert a["code"] == b["code"] and a["scene"] == b["scene"]
            assert (a["s_time"], a["e_time"]) == (b["s_time"], b["e_time"])
            assert math.isclose(a["lon"], b["lon"], abs_tol=1e-9)
            assert math.isclose(a["lat"], b["lat"], abs_tol=1e-9)


def test_smoothing_order_check_and_ping_pong(spark):
    df = interval_frame(
        spark,
        [
            ("u", "d", 1, "A", 0, 50, 1.0, 1.0, "ROAD"),
            ("u", "d", 2, "B", 30, 60, 1.0, 1.0, "ROAD"),
            ("u", "d", 3, "A", 60, 90, 1.0, 1.0, "ROAD"),
            ("v", "d", 4, "C", 0, 9, 1.0, 1.0, "ROAD"),
        ],
    )
    for line in (WHOLE, replace(DAILY, slice_ms=7)):
        smooth = {r["event_id"]: r["e_time"] for r in S.smooth_overlaps(df, line).collect()}
        assert smooth == {1: 30, 2: 60, 3: 90, 4: 9}
        dropped = S.smooth_overlaps(df, line, drop_single=True).collect()
        assert sorted(r["event_id"] for r in dropped) == [1, 2, 3]
        assert [r["event_id"] for r in S.validate_stay_order(df, line).collect()] == [2]
        codes = {r["event_id"]: r["code"] for r in S.suppress_ping_pong(df, line).collect()}
        assert codes == {1: "A", 2: "A", 3: "A", 4: "C"}
        with pytest.raises(Exception, match="stays overlap"):
            S.validate_stay_order(df, line, strict=True).collect()


def test_trace_text_in_parts_of_time(spark):
    df = interval_frame(
        spark, [("u", "d", i, f"c{i}", i + 1, i + 2, 1.0, 2.0, "ROAD") for i in range(7)]
    ).withColumn("duration", F.lit(1))
    whole = S.trace_serialise(df).collect()
    assert len(whole) == 1 and whole[0]["part"] == 0
    assert whole[0]["trace"].startswith("u,SECTOR#1.0,2.0,,c0,1,2,1,ROAD#")
    parts = S.trace_serialise(df, part_ms=3).orderBy("part").collect()
    assert [p["part"] for p in parts] == [0, 1, 2]
    head = "u,SECTOR"
    assert all(p["trace"].startswith(head + "#") for p in parts)
    assert head + "".join(p["trace"].removeprefix(head) for p in parts) == whole[0]["trace"]


def test_stay_lists_every_source(spark):
    points = spark.createDataFrame(
        [("u", "d", i, i, "A", 105.0, 26.5, "ROAD", "4G", s)
         for i, s in enumerate(["bill", "MR", "bill", None, "XDR"])],
        "imsi string, date string, event_id long, s_time long, code string, lon double, lat double, "
        "scene string, rat string, source string",
    )
    stay = S.stay_aggregate(points).collect()
    assert len(stay) == 1 and stay[0]["source"] == "|billMRXDR" and stay[0]["points"] == 5


def test_passages_restart_at_each_origin(spark):
    codes = ["O", "x", "O", "y", "D", "D", "O", "z"]
    df = interval_frame(
        spark,
        [("u", "d", i, c, i * 10, i * 10 + 5, 1.0, 1.0, "ROAD") for i, c in enumerate(codes)],
    )
    for line in (WHOLE, replace(DAILY, slice_ms=15)):
        legs = E.passages(df, F.lit("O"), F.lit("D"), line).collect()
        assert [(r["o"]["event_id"], r["d"]["event_id"]) for r in legs] == [(2, 4)]
        inner = E.sub_traces_between(df, F.lit("O"), F.lit("D"), line)
        assert sorted(r["event_id"] for r in inner.collect()) == [2, 3, 4]
        assert E.passages(df, F.lit("O"), F.lit("O"), line).count() == 0
