"""Readers of the upstream tables and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymarks.functions.calendar import SHANGHAI, Clock
from waymarks.functions.cells import cell_number, rat_of
from waymarks.operators.dims import NO_CELL

# ---- fixed values: markers of unusable lines and the positions of the text layouts ----------
UNUSABLE = ("unknow", "null", "\\N")
HOME_COUNTRY = "86"
SIGNALLING = {0: "date", 1: "phone", 2: "eci", 3: "imsi", 4: "imei", 5: "s_time", 7: "e_time"}
ROAMING = {
    0: "date",
    1: "phone",
    3: "s_time",
    4: "e_time",
    5: "country_code",
    6: "country_name",
    7: "country_name_en",
    8: "province_code",
    10: "next_start",
    11: "gap",
    14: "home_province_code",
    15: "home_province_name",
    16: "province_name",
}
AREA_FIELDS = (
    "scene_id",
    "scene_name",
    "cell",
    "city_id",
    "city_name",
    "county_id",
    "county_name",
)
DISTRICTS = {0: "cell", 6: "city_name", 7: "county_name"}
CUSTOM_CELL = 1
SUBSCRIBER = {1: "phone", 2: "imsi", 3: "age", 4: "income", 5: "home_cell", 7: "work_cell"}
USER_PLACES = {0: "phone", 1: "imsi", 2: "imei", 9: "work_cell", 14: "home_cell", 19: "holiday_cell"}
AGE_INCOME = {0: "phone", 1: "imsi", 2: "imei", 3: "age", 4: "income"}
# ---- end of fixed values -------------------------------------------------------------------


def _fields(lines: DataFrame, sep: str, layout: dict[int, str]) -> DataFrame:
    """The line and its fields by position; a missing field is NULL."""
    part = F.split("value", f"[{sep}]")
    named = [F.get(part, i).alias(n) for i, n in layout.items()]
    return lines.select("value", F.size(part).alias("_size"), *named)


def _told(rows: DataFrame, reason: Column, rejects: bool) -> DataFrame:
    """Rows without a reason to reject them; or the lines with one."""
    judged = rows.withColumn("reason", reason)
    if rejects:
        return judged.where(F.col("reason").isNotNull()).select("value", "reason")
    return judged.where(F.col("reason").isNull()).drop("value", "_size", "reason")


def _line_id() -> Column:
    """Order key of a line, from its content alone, so that every reading gives the same one.

    Equal lines have one key; they cannot be told apart, so their order never matters.
    """
    return F.xxhash64("value").alias("event_id")


def read_partition(
    source: DataFrame, columns: list[str], day: str, hour: str | None = None
) -> DataFrame:
    """Named columns of one day, or day and hour, of a table partitioned by day_id (and hour)."""
    rows = source.where(F.col("day_id") == day)
    if hour is not None:
        rows = rows.where(F.col("hour") == hour)
    return rows.select(*columns)


def read_partition_prefix(
    source: DataFrame, day: str, phone_prefix: str | None = None, exclude: bool = False
) -> DataFrame:
    """Partitions whose hour key starts with a day; optionally (not) of phones with a prefix."""
    rows = source.where(F.col("stat_hour").startswith(day))
    if phone_prefix is not None:
        match = F.col("msisdn").startswith(phone_prefix)
        rows = rows.where(~match if exclude else match)
    return rows


def read_signalling_tsv(
    spark: SparkSession, path, min_fields: int = 8, clock: Clock = SHANGHAI, rejects: bool = False
) -> DataFrame:
    """Tab text: 0 date, 1 phone, 2 cell, 3 imsi, 4 imei, 5 start, 7 end; and ``event_id``.

    Lines with a marker of missing data, too few fields, or a cell or time that cannot be read are
    left out; ``rejects`` gives those instead, as ``value`` and ``reason``.
    """
    rows = _fields(spark.read.text(path), "\t", SIGNALLING)
    marked = F.lit(False)
    for marker in UNUSABLE:
        marked = marked | F.col("value").contains(marker)
    read = rows.select(
        "value",
        "_size",
        _line_id(),
        "date",
        "phone",
        F.col("eci").try_cast("bigint").alias("eci"),
        "imsi",
        "imei",
        clock.parse(F.col("s_time")).alias("s_time"),
        clock.parse(F.col("e_time")).alias("e_time"),
        F.col("s_time").alias("_start"),
        F.col("e_time").alias("_end"),
    )
    unread = (F.col("_start").isNotNull() & F.col("s_time").isNull()) | (
        F.col("_end").isNotNull() & F.col("e_time").isNull()
    )
    reason = (
        F.when(marked, "missing data")
        .when(F.col("_size") < min_fields, "too few fields")
        .when(F.col("eci").isNull(), "unreadable cell")
        .when(unread, "unreadable time")
    )
    return _told(read, reason, rejects).drop("_start", "_end")


def read_multi_day(
    spark: SparkSession, pattern: str, min_fields: int = 8, clock: Clock = SHANGHAI
) -> DataFrame:
    """``read_signalling_tsv`` over a glob of day folders."""
    return read_signalling_tsv(spark, pattern, min_fields, clock)


def read_roaming_extract(
    spark: SparkSession,
    path,
    abroad: bool = False,
    clock: Clock = SHANGHAI,
    rejects: bool = False,
) -> DataFrame:
    """Pipe text of roaming stays at home (country 86) or abroad, with a visited province.

    Has ``event_id`` from the line's content.  Lines without a country or whose start or end cannot be
    read are left out; ``rejects`` gives those instead, as ``value`` and ``reason``.
    """
    rows = _fields(spark.read.text(path), "|", ROAMING)
    times = {c: clock.parse(F.col(c)) for c in ("s_time", "e_time", "next_start")}
    read = rows.withColumn("event_id", F.xxhash64("value")).withColumns(times)
    reason = F.when(F.coalesce("country_code", F.lit("")) == "", "no country").when(
        F.col("s_time").isNull() | F.col("e_time").isNull(), "unreadable time"
    )
    told = _told(read, reason, rejects)
    if rejects:
        return told
    domestic = F.col("country_code") == HOME_COUNTRY
    visited = F.coalesce("province_code", F.lit("")) != ""
    return told.where((~domestic if abroad else domestic) & visited)


def _with_code(rows: DataFrame) -> DataFrame:
    """Technology and normalised code of the column ``cell``; rows without a readable cell go."""
    coded = rows.select(
        "*",
        rat_of(F.col("cell")).alias("rat"),
        cell_number(F.col("cell")).cast("string").alias("code"),
    )
    return coded.where(F.col("code") != NO_CELL)


def load_area_dim(
    spark: SparkSession, path, sep: str = "|", rejects: bool = False
) -> DataFrame:
    """Area file as a cell lookup with technology and normalised code.

    2G cells are normalised like those of the points, so both technologies join on (code, rat).  A
    cell has a row for each of its scenes; ``one_row_per_cell`` makes it unique.  Lines with ``-``, short
    lines and lines whose cell cannot be read are left out; ``rejects`` gives those instead.
    """
    rows = _fields(spark.read.text(path), sep, dict(enumerate(AREA_FIELDS)))
    reason = (
        F.when(F.col("value").contains("-"), "marked with -")
        .when(F.col("_size") < len(AREA_FIELDS), "too few fields")
        .when(cell_number(F.col("cell")).cast("string") == NO_CELL, "unreadable cell")
    )
    told = _told(rows, reason, rejects)
    return told if rejects else _with_code(told)


def load_district_dim(spark: SparkSession, path) -> DataFrame:
    """Tab file of 4G cells: 0 cell, 6 city, 7 district; with technology and code."""
    rows = _fields(spark.read.text(path), "\t", DISTRICTS).drop("value", "_size")
    return _with_code(rows.where(F.col("county_name").isNotNull()))


def load_custom_area(spark: SparkSession, path, area: str) -> DataFrame:
    """Comma file of cells (field 1) that make up one area: code, rat and ``area_code``."""
    rows = _fields(spark.read.text(path), ",", {CUSTOM_CELL: "cell"}).where(F.col("cell").isNotNull())
    return _with_code(rows.select("cell")).select("code", "rat", F.lit(area).alias("area_code"))


def filter_area_dim_by_scene(
    area: DataFrame, scene_ids: tuple[str, ...] = (), scene_names: tuple[str, ...] = ()
) -> DataFrame:
    """Cells of the chosen scenes, by id or by name."""
    return area.where(
        F.col("scene_id").isin(*scene_ids) | F.col("scene_name").isin(*scene_names)
    )


CELL_SITES = T.StructType(
    [
        T.StructField("eci", T.LongType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
    ]
)


def load_cell_sites(spark: SparkSession, path, sep: str = ",") -> DataFrame:
    """Cell parameter table; a missing path is Spark's own error."""
    return spark.read.csv(path, sep=sep, schema=CELL_SITES)


def load_subscriber_dim(spark: SparkSession, path, sep: str = "|") -> DataFrame:
    """Subscriber file: 1 phone, 2 imsi, 3 age, 4 income, 5 home cell, 7 work cell.

    The file has no ``imei``; the column is NULL.
    """
    rows = _fields(spark.read.text(path), sep, SUBSCRIBER)
    return rows.select(
        "phone",
        "imsi",
        F.lit(None).cast("string").alias("imei"),
        F.col("age").try_cast("int").alias("age"),
        F.col("income").try_cast("double").alias("income"),
        "home_cell",
        "work_cell",
    )


def load_user_places(spark: SparkSession, path) -> DataFrame:
    """Tab file: 0 phone, 1 imsi, 2 imei, 9 work cell, 14 home cell, 19 holiday cell."""
    return _fields(spark.read.text(path), "\t", USER_PLACES).drop("value", "_size")


def load_age_income(spark: SparkSession, path) -> DataFrame:
    """Tab file: 0 phone, 1 imsi, 2 imei, 3 age, 4 income."""
    rows = _fields(spark.read.text(path), "\t", AGE_INCOME).drop("value", "_size")
    return rows.withColumns(
        {"age": F.col("age").try_cast("int"), "income": F.col("income").try_cast("double")}
    )


def with_age_income(places: DataFrame, incomes: DataFrame) -> DataFrame:
    """Users' places with age and income by phone, where known; the first of several rows counts."""
    known = incomes.groupBy("phone").agg(F.min(F.struct("age", "income")).alias("_known"))
    return places.join(known, "phone", "left").select(
        *places.columns, F.col("_known.age").alias("age"), F.col("_known.income").alias("income")
    )


def extract_subscriber_rows(rows: DataFrame, phone: str) -> DataFrame:
    return rows.where(F.col("phone") == phone)
