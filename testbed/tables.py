"""Domain tables derived from the given parquet tables.

``events`` become located points and intervals, ``part`` the cell dimension, ``customer`` the
subscribers and ``orders`` the tickets.  ``sqlviews`` defines the same views in SQL.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymarks.functions import cells as C
from waymarks.functions.calendar import UTC, wall_ms
from waymarks.operators.od import PHONE
from waymarks.operators.ordered import DAILY, LIFETIME, Timeline
from waymarks.operators.stays import merge_adjacent_stays
from waymarks.plans.jobs import TICKET


def div(value: Column, by: int) -> Column:
    return F.floor(value / F.lit(by))


def eci_of(k: Column) -> Column:
    return F.lit(25600).cast("bigint") + div(k, 4) * 256 + k % 4


def cell_of(k: Column) -> Column:
    return F.when(k % 5 == 0, F.concat_ws("_", k, k % 4)).otherwise(eci_of(k).cast("string"))


def lon_of(k: Column) -> Column:
    return F.lit(105.0) + (k % 10) * F.lit(0.02)


def lat_of(k: Column) -> Column:
    return F.lit(26.5) + (div(k, 10) % 100) * F.lit(0.02)


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.dir, f"{name}.parquet"))

    def scratch(self, name: str) -> str:
        """A new folder for derived files, in the folder that all executors share."""
        base = self.spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not self.spark.conf.get("spark.master", "local").startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="run-")
        return os.path.join(base, f"{name}-{uuid.uuid4().hex}")

    def events(self) -> DataFrame:
        return self.raw("events").select(
            F.col("user_id").cast("string").alias("imsi"),
            F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("date"),
            "event_id",
            "user_id",
            wall_ms(F.col("ts")).alias("s_time"),
            "event_type",
            "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
        )

    def points(self) -> DataFrame:
        """Located points; positions scatter around their cell."""
        k = F.col("k")
        types = F.create_map(
            *[
                F.lit(v)
                for pair in (
                    ("view", "5"),
                    ("click", "6"),
                    ("purchase", "2"),
                    ("signup", "7"),
                    ("error", "8"),
                )
                for v in pair
            ]
        )
        p = self.events().withColumns(
            {
                "loc_type": types[F.col("event_type")],
                "cell": cell_of(k),
                "eci": eci_of(k),
                "lon": lon_of(k) + F.col("value") * F.lit(1.1371859e-5),
                "lat": lat_of(k) + F.col("value") * F.lit(4.7131859e-6),
                "scene": F.when(F.col("value") >= 20, "INDOOR").otherwise("ROAD"),
            }
        )
        return p.withColumns(
            {
                "source": C.source_of(F.col("loc_type")),
                "rat": C.rat_of(F.col("cell")),
                "code": C.cell_number(F.col("cell")).cast("string"),
            }
        ).drop("event_type", "user_id")

    def intervals(self, code: str = "cell") -> DataFrame:
        """Stays given as intervals at cell, county, city or province level."""
        k = F.col("k")
        codes = {
            "cell": C.cell_number(cell_of(k)).cast("string"),
            "eci": eci_of(k).cast("string"),
            "county": F.concat(F.lit("C"), div(k, 10)),
            "city": F.concat(F.lit("T"), div(k, 25)),
        }
        return self.events().select(
            "imsi",
            "date",
            "event_id",
            codes[code].alias("code"),
            "s_time",
            (F.col("s_time") + F.floor(F.col("value") * 600000.0)).alias("e_time"),
            F.floor(F.col("value") * 600000.0).alias("duration"),
            lon_of(k).alias("lon"),
            lat_of(k).alias("lat"),
            F.when(F.col("value") >= 20, "INDOOR").otherwise("ROAD").alias("scene"),
            C.rat_of(cell_of(k)).alias("rat"),
        )

    def cells(self) -> DataFrame:
        """Cell dimension with scene, county, city and province."""
        k = F.col("k")
        kind = k % 10
        scene_id = (
            F.when(kind == 0, "YDY3")
            .when(kind == 1, "YDY2")
            .when(kind.isin(2, 3, 4), "YDY9")
            .otherwise("YDY0")
        )
        scene_name = (
            F.when(kind == 0, "高铁站")
            .when(kind == 1, "飞机场")
            .when(kind == 2, "学校")
            .when(kind == 3, "医院")
            .when(kind == 4, "商务区")
            .otherwise("其他")
        )
        return (
            self.raw("part")
            .select(F.col("p_partkey").alias("k"))
            .select(
                "k",
                eci_of(k).alias("eci"),
                cell_of(k).alias("cell"),
                C.rat_of(cell_of(k)).alias("rat"),
                C.cell_number(cell_of(k)).cast("string").alias("code"),
                scene_id.alias("scene_id"),
                scene_name.alias("scene_name"),
                F.concat(F.lit("C"), div(k, 10)).alias("county_id"),
                F.concat(F.lit("county "), div(k, 10)).alias("county_name"),
                F.concat(F.lit("T"), div(k, 25)).alias("city_id"),
                F.concat(F.lit("city "), div(k, 25)).alias("city_name"),
                F.concat(F.lit("P"), div(k, 50)).alias("province_id"),
                lon_of(k).alias("lon"),
                lat_of(k).alias("lat"),
            )
        )

    def subscribers(self) -> DataFrame:
        """Subscribers with home, work and holiday places of the three kinds."""
        u = F.col("c_custkey")

        def place(k: Column) -> Column:
            return F.struct(
                F.concat(F.lit("C"), k % 10).alias("aoi"),
                F.concat(F.lit("C"), (k + 3) % 10).alias("grid"),
                eci_of(k).cast("string").alias("sector"),
            )

        home, work, holiday = u % 100, (u * 7 + 8) % 100, (u * 11 + 10) % 100
        return self.raw("customer").select(
            u.cast("string").alias("imsi"),
            F.concat(F.lit("138"), u).alias("phone"),
            F.concat(F.lit("86"), u).alias("imei"),
            (F.lit(18) + u % 50).cast("int").alias("age"),
            F.col("c_acctbal").alias("income"),
            F.when(u % 2 == 0, "Male").otherwise("Female").alias("gender"),
            F.when(u % 3 == 0, "G5").otherwise("G4").alias("network"),
            place(home).alias("live"),
            place(work).alias("work"),
            eci_of(home).cast("string").alias("home_cell"),
            eci_of(work).cast("string").alias("work_cell"),
            eci_of(holiday).cast("string").alias("holiday_cell"),
        )

    def tickets(self) -> DataFrame:
        """Call and data tickets with hexadecimal area and cell."""
        o = F.col("o_orderkey")
        return self.raw("orders").select(
            o.alias("event_id"),
            F.col("o_custkey").cast("string").alias("imsi"),
            F.concat(F.lit("138"), F.col("o_custkey")).alias("phone"),
            F.concat(F.lit("R"), o % 7).alias("city_code"),
            F.concat(F.lit("D"), o % 11).alias("county_code"),
            F.hex(o % 50000 + 4096).alias("lac"),
            F.concat(
                F.hex((o * 37) % 100000), F.when(o % 3 == 0, "|1100").otherwise("")
            ).alias("cell"),
            F.date_format(
                F.date_add(F.lit("2024-01-01").cast("date"), (o % 30).cast("int")), "yyyyMMdd'103000'"
            ).alias("start_text"),
            F.floor(F.col("o_totalprice") / 100).alias("seconds"),
            F.when(o % 2 == 0, "voice").otherwise("data").alias("service"),
            F.when(o % 4 < 2, "local").otherwise("out").alias("origin"),
        )

    def roaming(self) -> DataFrame:
        """One row per subscriber-day: province and country of the day's last event."""
        e = self.events()
        last_k = F.max_by("k", F.struct("s_time", "event_id"))
        days = e.groupBy("imsi", "date").agg(
            F.min("event_id").alias("event_id"),
            F.min("s_time").alias("s_time"),
            F.max("s_time").alias("e_time"),
            last_k.alias("k"),
        )
        k = F.col("k")
        return days.select(
            F.concat(F.lit("138"), F.col("imsi")).alias("phone"),
            "event_id",
            "date",
            "s_time",
            "e_time",
            F.when(k % 4 == 0, "66").otherwise("86").alias("country_code"),
            F.when(k % 4 == 0, "泰国").otherwise("中国").alias("country_name"),
            F.when(k % 4 == 0, "Thailand").otherwise("China").alias("country_name_en"),
            F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("P"), div(k, 10))).alias(
                "province_code"
            ),
            F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("province "), div(k, 10))).alias(
                "province_name"
            ),
            F.lit("P0").alias("home_province_code"),
            F.lit("province 0").alias("home_province_name"),
        )

    def signalling(self) -> DataFrame:
        """Roaming signalling rows: one per event, phone with country prefix."""
        k = F.col("k")
        return self.events().select(
            F.concat(F.lit("P"), k % 10).alias("home_province"),
            "imsi",
            F.concat(
                F.when(F.col("user_id") % 4 == 0, "66").otherwise("86"), F.lit("138"), F.col("imsi")
            ).alias("msisdn"),
            "event_id",
            "date",
            "s_time",
            eci_of(k).cast("string").alias("cell"),
            lon_of(k).alias("lon"),
            lat_of(k).alias("lat"),
            F.concat(
                F.date_format(UTC.day(F.col("s_time")), "yyyyMMdd"),
                F.lpad(UTC.hour(F.col("s_time")).cast("string"), 2, "0"),
            ).alias("stat_hour"),
        )

    def trace(self) -> DataFrame:
        """County-level traces: overlaps cut, neighbours in one county merged."""
        return merge_adjacent_stays(
            self.intervals("county"), self.daily(), smooth=True, midpoint=False
        )

    def daily(self) -> Timeline:
        """Traces of a subscriber and day."""
        return DAILY

    def lifetime(self) -> Timeline:
        return LIFETIME

    def by_phone(self) -> Timeline:
        return PHONE

    def by_ticket(self) -> Timeline:
        return TICKET

    def hubs(self) -> DataFrame:
        return self.cells().where(F.col("scene_id").isin("YDY2", "YDY3"))
