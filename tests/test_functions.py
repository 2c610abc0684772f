"""Geometry, geohash, calendar and cell identifiers on known values."""

import pytest
from pyspark.sql import functions as F

from waymarks.functions import geo, geohash
from waymarks.functions.calendar import SHANGHAI, UTC
from waymarks.operators import clean


def test_projection_round_trip(spark):
    df = spark.createDataFrame([(284412.6898810635, 4218172.101956899)], "x double, y double")
    there = geo.with_degrees(df, meridian=117)
    back = geo.with_metres(there, x="x2", y="y2", meridian=117).first()
    assert back["x2"] == pytest.approx(284412.6898810635, abs=2e-3)
    assert back["y2"] == pytest.approx(4218172.101956899, abs=2e-3)
    nothing = spark.createDataFrame([(None, 1.0)], "lon double, lat double")
    assert geo.with_metres(nothing).first()["x"] is None


def bisected(lon, lat):
    spans, bits = {"lon": [-180.0, 180.0], "lat": [-90.0, 90.0]}, ""
    for i in range(60):
        axis, value = ("lon", lon) if i % 2 == 0 else ("lat", lat)
        mid = sum(spans[axis]) / 2
        upper = value > mid
        spans[axis][0 if upper else 1] = mid
        bits += "1" if upper else "0"
    return "".join(geohash.ALPHABET[int(bits[i : i + 5], 2)] for i in range(0, 60, 5))


def test_geohash_equals_bisection(spark):
    places = [
        (10.40744, 57.64911), (105.0, 26.5), (112.5, 45.0), (0.0, 0.0), (-180.0, -90.0),
        (180.0, 90.0), (-0.0124, 51.4797), (106.7135, 26.578343),
    ]
    df = spark.createDataFrame(places, "lon double, lat double")
    code = geohash.encode(F.col("lon"), F.col("lat"))
    swapped = geohash.encode(F.col("lon"), F.col("lat"), compat=True)
    for r in df.select("lon", "lat", code.alias("g"), swapped.alias("s")).collect():
        assert r["g"] == bisected(r["lon"], r["lat"])
        assert r["s"] == bisected(r["lat"], r["lon"])
    assert bisected(10.40744, 57.64911) == "u4pruydqqvj8"


def test_geohash_decode_of_any_length(spark):
    df = spark.createDataFrame([("u4pruydqqvj8",), ("ezs42",)], "g string")
    lat, lon, lat_err, lon_err = geohash.decode(F.col("g"))
    full, short = df.select(lat.alias("a"), lon.alias("o"), lat_err.alias("e"), lon_err.alias("f")).collect()
    assert full["a"] == pytest.approx(57.64911, abs=1e-6)
    assert full["o"] == pytest.approx(10.40744, abs=1e-6)
    assert short["a"] == pytest.approx(42.605, abs=1e-3)
    assert short["o"] == pytest.approx(-5.603, abs=1e-3)
    assert short["e"] == pytest.approx(0.022, abs=1e-3) and short["f"] == short["e"]


def test_calendar(spark):
    df = spark.createDataFrame([("2017-04-14 07:29:03",), ("2021-05-24 00:00:00",), ("junk",)], "t string")
    ms = SHANGHAI.parse(F.col("t"))
    rows = df.select(
        SHANGHAI.hour(ms).alias("h"), SHANGHAI.iso_weekday(ms).alias("w"),
        UTC.hour(ms).alias("u"), SHANGHAI.second_label(ms).alias("s"),
    ).collect()
    assert (rows[0]["h"], rows[0]["u"], rows[0]["s"]) == (7, 23, "2017-04-14 07:29:03")
    assert rows[1]["w"] == 1 and rows[2]["h"] is None


def test_voice_and_data_cells(spark):
    df = spark.createDataFrame(
        [("1A2B", "FFFF", "20240101000000", 5), ("1A2B", "10000|1100", "20240101000000", 5),
         ("", "10", "20240101000000", None)],
        "lac string, cell string, start_text string, seconds int",
    )
    voice = [r["code"] for r in clean.ticket_stays(df, "voice").collect()]
    assert voice == ["6699-65535", "65536", "16"]
    compat = [r["code"] for r in clean.ticket_stays(df, "voice", compat=True).collect()]
    assert compat[0] == str(6699 - 65535)
    rows = clean.ticket_stays(df, "data").collect()
    assert rows[0]["code"] == str(6699 * 256 + 65535)
    assert rows[0]["e_time"] - rows[0]["s_time"] == 5000


def test_cell_numbers(spark):
    df = spark.createDataFrame([("12_34",), ("567",), ("x",), ("1_y",), ("7_",)], "cell string")
    rows = clean.classify_rat(clean.normalise_cell_id(df)).collect()
    assert [r["cell_number"] for r in rows] == [1200034, 567, 0, 0, 0]
    assert [r["rat"] for r in rows] == [2, 6, 6, 2, 2]


def test_location_lines(spark):
    lines = spark.createDataFrame(
        [("imsi4,1599622711000,1599623311000,,50000,4294967295,INDOOR,3695368,15,25",),
         ("imsi4,1,2,,50000,50256,ROAD,7,15,25",)],
        "value string",
    )
    rows = clean.parse_location_csv(lines).collect()
    assert rows[0]["eci"] == 50000 and rows[0]["scene"] == "INDOOR" and rows[0]["lon"] == 15
    both = [(r["role"], r["s_time"], r["eci"]) for r in clean.expand_source_target_cell(lines).collect()]
    assert both == [("source", 1599622711000, 50000), ("source", 1, 50000), ("target", 2, 50256)]


def test_session_that_starts_indoors_has_one_grid(spark):
    data = [("u", "d", i, i, s, 105 + i * 0.01, 26.0) for i, s in enumerate(["INDOOR", "ROAD", "ROAD"])]
    data += [("v", "d", i, i, s, 105 + i * 0.01, 26.0) for i, s in enumerate(["ROAD", "INDOOR"])]
    df = spark.createDataFrame(
        data, "imsi string, date string, event_id int, s_time int, scene string, lon double, lat double"
    )
    grids = clean.grid_indoor_session(df, size=20).groupBy("imsi").agg(F.count_distinct("grid_code"))
    assert dict(grids.collect()) == {"u": 1, "v": 2}
