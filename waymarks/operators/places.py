"""Home and work places, stay kinds and mobility classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymarks.functions.calendar import HOUR_MS, SHANGHAI, Clock
from waymarks.operators.traces import WORK_END_HOUR, WORK_START_HOUR

# ---- fixed values: day-part bounds, shares and day counts of the definitions -------------
NIGHT_UNTIL_HOUR = 6
NIGHT_FROM_HOUR = 22
MIN_DAYS = 365
MIN_SHARE = 0.5
MIN_WORK_HOURS = 1.0
INHABITANT_DAYS = 180
MIGRANT_DAYS = 7
LONGEST_SPAN_DAYS = 367
KIND_NIGHT = (21, 29)
KIND_WORK = (9, 17)
LINGER_HOURS = 0.5
TRANSIENT_HOURS = 6
# ---- end of fixed values ------------------------------------------------------------------


def _at_night(hour: Column) -> Column:
    return (hour <= NIGHT_UNTIL_HOUR) | (hour >= NIGHT_FROM_HOUR)


def night_stays(stays: DataFrame, clock: Clock = SHANGHAI) -> DataFrame:
    """Stays that start or end at night."""
    return stays.where(
        _at_night(clock.hour(F.col("s_time"))) | _at_night(clock.hour(F.col("e_time")))
    )


def work_stays(stays: DataFrame, clock: Clock = SHANGHAI) -> DataFrame:
    """Add ``work_ms``: the whole stay when it lies inside working hours, else 0."""
    inside = (clock.hour(F.col("s_time")) > WORK_START_HOUR) & (
        clock.hour(F.col("e_time")) < WORK_END_HOUR
    )
    return stays.withColumn(
        "work_ms", F.when(inside, F.col("e_time") - F.col("s_time")).otherwise(F.lit(0))
    )


def _days_at_places(stays: DataFrame, min_hours: float, clock: Clock) -> DataFrame:
    """Per subscriber and code: days with a night there, days of work there, and ``_present``.

    One row for each subscriber, code and day knows both.  Of a day's codes the first one carries the
    day, so the sum of ``_present`` over codes is the number of days.
    """
    night = _at_night(clock.hour(F.col("s_time"))) | _at_night(clock.hour(F.col("e_time")))
    daily = (
        work_stays(stays, clock)
        .groupBy("imsi", "date", "code")
        .agg(F.max(night).alias("_night"), F.sum("work_ms").alias("_ms"))
    )
    codes = Window.partitionBy("imsi", "date").orderBy("code")
    dated = F.col("date").isNotNull()
    carries = dated & (F.row_number().over(codes) == 1)
    return (
        daily.withColumn("_carries", carries)
        .groupBy("imsi", "code")
        .agg(
            F.count_if(F.col("_night") & dated).alias("_nights"),
            F.count_if(F.col("_ms") > min_hours * HOUR_MS).alias("_work_days"),
            F.count_if("_carries").alias("_present"),
        )
    )


def _steady(days: str, min_days: int, min_share: float) -> tuple[Column, Column]:
    """The place with the most days, as (-days, code), and whether it covers enough of all days."""
    ranked = F.when(F.col(days) > 0, F.struct((-F.col(days)).alias("m"), "code"))
    present = F.sum("_present")
    best = F.min(ranked)
    return best, (present > min_days) & (-best["m"] / present > min_share)


def _steady_place(days_at: DataFrame, days: str, min_days: int, min_share: float) -> DataFrame:
    best, enough = _steady(days, min_days, min_share)
    found = days_at.groupBy("imsi").agg(
        best.alias("_best"), F.sum("_present").alias("total_days"), enough.alias("_enough")
    )
    return found.where(F.col("_enough")).select(
        "imsi",
        F.col("_best.code").alias("code"),
        (-F.col("_best.m")).alias("days"),
        "total_days",
    )


def live_place(
    stays: DataFrame,
    min_days: int = MIN_DAYS,
    min_share: float = MIN_SHARE,
    clock: Clock = SHANGHAI,
) -> DataFrame:
    """Home: the place with the most nights, on more than ``min_share`` of the days present."""
    days_at = _days_at_places(stays, MIN_WORK_HOURS, clock)
    return _steady_place(days_at, "_nights", min_days, min_share)


def work_place(
    stays: DataFrame,
    min_days: int = MIN_DAYS,
    min_share: float = MIN_SHARE,
    min_hours: float = MIN_WORK_HOURS,
    clock: Clock = SHANGHAI,
) -> DataFrame:
    """Work: the place with the most days of more than ``min_hours`` working-time dwell."""
    days_at = _days_at_places(stays, min_hours, clock)
    return _steady_place(days_at, "_work_days", min_days, min_share)


def home_and_work(
    stays: DataFrame,
    min_days: int = MIN_DAYS,
    live_share: float = MIN_SHARE,
    work_share: float = MIN_SHARE,
    min_hours: float = MIN_WORK_HOURS,
    clock: Clock = SHANGHAI,
) -> DataFrame:
    """``live_place`` and ``work_place`` of every subscriber in one pass; NULL where there is none."""
    live, lives = _steady("_nights", min_days, live_share)
    work, works = _steady("_work_days", min_days, work_share)
    return (
        _days_at_places(stays, min_hours, clock)
        .groupBy("imsi")
        .agg(
            F.when(lives, live["code"]).alias("live_code"),
            F.when(works, work["code"]).alias("work_code"),
            F.sum("_present").alias("total_days"),
        )
    )


def place_of_kind(subscribers: DataFrame, kind: str) -> DataFrame:
    """Home and work code of one place kind."""
    field = kind.lower()
    return subscribers.select(
        "imsi",
        F.col(f"live.{field}").alias("live_code"),
        F.col(f"work.{field}").alias("work_code"),
    )


def stay_kind(stays: DataFrame, clock: Clock = SHANGHAI, keys=("imsi", "date")) -> DataFrame:
    """Label stays LIVE, WORK, WORKLIVE, LINGER or PASSBY.

    LIVE is the place with the longest dwell between 21:00 and 05:00 of the trace's day, WORK
    between 09:00 and 17:00; other stays linger when longer than 30 minutes.
    """
    midnight = clock.day_ms(F.col("date"))

    def dwell(bounds: tuple[int, int]) -> Column:
        start, end = (midnight + h * HOUR_MS for h in bounds)
        inside = F.least(F.col("e_time"), end) - F.greatest(F.col("s_time"), start)
        return F.sum(F.greatest(inside, F.lit(0)))

    def longest(column: str) -> Column:
        ranked = F.struct((-F.col(column)).alias("m"), "code")
        return F.min(F.when(F.col(column) > 0, ranked))["code"]

    places = (
        stays.groupBy(*keys, "code")
        .agg(dwell(KIND_NIGHT).alias("_night"), dwell(KIND_WORK).alias("_work"))
        .groupBy(*keys)
        .agg(longest("_night").alias("_live"), longest("_work").alias("_office"))
    )
    is_live = F.coalesce(F.col("code") == F.col("_live"), F.lit(False))
    is_work = F.coalesce(F.col("code") == F.col("_office"), F.lit(False))
    kind = (
        F.when(is_live & is_work, "WORKLIVE")
        .when(is_live, "LIVE")
        .when(is_work, "WORK")
        .when(F.col("e_time") - F.col("s_time") > LINGER_HOURS * HOUR_MS, "LINGER")
        .otherwise("PASSBY")
    )
    return stays.join(places, list(keys)).withColumn("kind", kind).drop("_live", "_office")


def mobility_class(
    stays: DataFrame,
    code: str,
    inhabitant_days: int = INHABITANT_DAYS,
    migrant_days: int = MIGRANT_DAYS,
    min_span_days: int = MIN_DAYS,
    max_span_days: int = LONGEST_SPAN_DAYS,
) -> DataFrame:
    """INHABITANT, MIGRANT, TRANSIT or ABSENT at a place by days present; LessDate when the
    observed span is too short or too long."""
    per_user = stays.groupBy("imsi").agg(
        F.date_diff(F.to_date(F.max("date")), F.to_date(F.min("date"))).alias("span_days"),
        F.count_distinct(F.when(F.col("code") == code, F.col("date"))).alias("days"),
    )
    days, span = F.col("days"), F.col("span_days")
    return per_user.withColumn(
        "mobility",
        F.when((span < min_span_days) | (span > max_span_days), "LessDate")
        .when(days > inhabitant_days, "INHABITANT")
        .when(days > migrant_days, "MIGRANT")
        .when(days > 0, "TRANSIT")
        .otherwise("ABSENT"),
    )


def mobility_flags(classes: DataFrame) -> DataFrame:
    """1 or 0 for inhabitants and migrants, -1 when the class is unknown."""

    def flag(name: str) -> Column:
        m = F.col("mobility")
        return F.when(m.isNull(), -1).when(m == name, 1).otherwise(0)

    return classes.withColumns(
        {"is_inhabitant": flag("INHABITANT"), "is_migrant": flag("MIGRANT")}
    )


def is_transient(
    stays: DataFrame, crowd: DataFrame, code: str, hours: float = TRANSIENT_HOURS
) -> DataFrame:
    """Traces of crowd members that visit the place for less than ``hours`` in total."""
    visits = stays.where(F.col("code") == code).groupBy("imsi", "date").agg(
        F.sum("duration").alias("total_ms")
    )
    return visits.where(F.col("total_ms") < hours * HOUR_MS).join(
        crowd.select("imsi"), "imsi", "left_semi"
    )
