"""Crowds: sets of subscribers, unique by imsi, and what can be said about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymarks.functions.calendar import HOUR_MS
from waymarks.operators.intervals import whole_intervals

KIND_FIELDS = ("aoi", "grid", "sector")
SECTOR_AREA = 300.0


def headcount(crowd: DataFrame) -> DataFrame:
    return crowd.agg(F.count_distinct("imsi").alias("users"))


def crowd_is_empty(crowd: DataFrame) -> DataFrame:
    """Whether nobody is in the crowd; one row is enough to know."""
    return crowd.select(F.lit(1).alias("_one")).limit(1).agg((F.count("_one") == 0).alias("is_empty"))


def crowd_non_empty(crowd: DataFrame) -> DataFrame:
    return crowd.select(F.lit(1).alias("_one")).limit(1).agg((F.count("_one") > 0).alias("non_empty"))


def crowd_add_users(crowd: DataFrame, newcomers: DataFrame) -> DataFrame:
    """Add users; one who is already there is replaced.

    A crowd is unique by imsi: of several rows of one newcomer the largest, compared column by
    column, stays.
    """
    both = crowd.withColumn("_new", F.lit(0)).unionByName(newcomers.withColumn("_new", F.lit(1)))
    rest = [c for c in crowd.columns if c != "imsi"]
    latest = both.groupBy("imsi").agg(F.max(F.struct("_new", *rest)).alias("_user"))
    return latest.select(*[F.col("imsi") if c == "imsi" else F.col("_user")[c].alias(c) for c in crowd.columns])


def _at(side: str, kind: str, code: str) -> Column:
    return F.col(f"{side}.{kind.lower()}") == code


def crowd_by_live(crowd: DataFrame, kind: str, code: str) -> DataFrame:
    return crowd.where(_at("live", kind, code))


def crowd_by_work(crowd: DataFrame, kind: str, code: str) -> DataFrame:
    return crowd.where(_at("work", kind, code))


def crowd_live_work(crowd: DataFrame, kind: str, live: str, work: str) -> DataFrame:
    return crowd.where(_at("live", kind, live) & _at("work", kind, work))


def _any_kind(side: str, code: str) -> Column:
    return F.array_contains(F.array(*[F.col(f"{side}.{k}") for k in KIND_FIELDS]), code)


def live_crowd_any_kind(users: DataFrame, code: str) -> DataFrame:
    """Users whose home is the place, whichever kind of code it is."""
    return users.where(_any_kind("live", code))


def work_crowd_any_kind(users: DataFrame, code: str) -> DataFrame:
    return users.where(_any_kind("work", code))


def migrant_crowd(crowd: DataFrame, classes: DataFrame) -> DataFrame:
    """Members classed MIGRANT by ``mobility_class``."""
    return crowd.join(
        classes.where(F.col("mobility") == "MIGRANT").select("imsi"), "imsi", "left_semi"
    )


def travel_out_crowd(users: DataFrame, code: str, day_ods: DataFrame) -> DataFrame:
    """Residents of a place who made a day trip (``one_day_od``)."""
    return live_crowd_any_kind(users, code).join(day_ods.select("imsi"), "imsi", "left_semi")


def crowd_to_destination(
    users: DataFrame, code: str, day_ods: DataFrame, destination: str
) -> DataFrame:
    """Residents of a place whose day trip ended at the destination."""
    arrived = day_ods.where(F.col("d_code") == destination).select("imsi")
    return live_crowd_any_kind(users, code).join(arrived, "imsi", "left_semi")


def linger_crowd(
    users: DataFrame, stays: DataFrame, code: str, start: int | Column, end: int | Column
) -> DataFrame:
    """Users with a stay at the place that overlaps [start, end)."""
    there = stays.where(
        (F.col("code") == code) & (F.col("s_time") < end) & (F.col("e_time") > start)
    )
    return users.join(there.select("imsi"), "imsi", "left_semi")


def linger_crowds(
    stays: DataFrame, windows: DataFrame, bucket_ms: int = HOUR_MS
) -> DataFrame:
    """Users with a stay at the place of each window that overlaps it: ``window``, ``imsi``.

    ``windows``: ``window``, ``code`` and [``start``, ``end``).

    Of a user's stays that overlap a window the earliest alone gives the row: the one that no earlier
    stay there outlasts up to the window's start (``_seen``).  So pairs need no shuffle to be unique,
    unless one ``window`` has several spans or codes.
    """
    earlier = (
        Window.partitionBy("imsi", "code")
        .orderBy("s_time", F.desc("e_time"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    there = whole_intervals(stays.select("imsi", "code", "s_time", "e_time"), "s_time", "e_time")
    there = (
        there.where(F.col("code").isNotNull())
        .withColumn("_seen", F.coalesce(F.max("e_time").over(earlier), F.lit(-(2**63)).cast("bigint")))
        .where(F.col("e_time") > F.col("_seen"))
    )
    spans = windows.select("window", "code", F.col("start").alias("w_start"), F.col("end").alias("w_end"))
    spans = (
        whole_intervals(spans, "w_start", "w_end")
        .where(F.col("code").isNotNull())
        .distinct()
        .withColumn("_spans", F.count(F.lit(1)).over(Window.partitionBy("window")))
    )

    # Even buckets: the window starts during the stay.  Odd ones: the stay starts during the window.
    def buckets(first: Column, last: Column, odd: int) -> Column:
        a, b = (F.floor(c / F.lit(bucket_ms)) * 2 + odd for c in (first, last))
        return F.when(first <= last, F.sequence(a, b, F.lit(2).cast("bigint"))).otherwise(
            F.array().cast("array<bigint>")
        )

    s, e, f, u, seen = (F.col(c) for c in ("s_time", "e_time", "w_start", "w_end", "_seen"))
    starts = F.when(s > seen, F.array(F.floor(s / F.lit(bucket_ms)) * 2 + 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    dealt = there.withColumn(
        "_bucket", F.explode(F.concat(buckets(F.greatest(s, seen), e - 1, 0), starts))
    )
    spans = spans.withColumn("_bucket", F.explode(F.concat(buckets(f, f, 0), buckets(f + 1, u - 1, 1))))
    even = F.col("_bucket") % 2 == 0

    # The number of partitions is given: the size of the input says little about the number of pairs.
    parts = int(stays.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "code", "_bucket")

    def met(some: DataFrame) -> DataFrame:
        pairs = dealt.join(some.drop("_spans").repartition(parts, "code", "_bucket"), ["code", "_bucket"])
        found = pairs.where((f >= seen) & (f < e) & (s < u) & ((f >= s) == even))
        return found.select("window", "imsi")

    return met(spans.where(F.col("_spans") == 1)).unionByName(
        met(spans.where(F.col("_spans") > 1)).distinct()
    )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def gender_insight(crowd: DataFrame) -> DataFrame:
    male, everyone = F.count_if(F.col("gender") == "Male"), F.count(F.lit(1))
    return crowd.agg(
        male.alias("male"),
        (everyone - male).alias("female"),
        _share(male, everyone).alias("male_ratio"),
        _share(everyone - male, everyone).alias("female_ratio"),
    )


def arpu_insight(crowd: DataFrame, revenue: str = "income") -> DataFrame:
    return crowd.agg(F.coalesce(F.sum(revenue), F.lit(0.0)).alias("total_arpu"))


def network_5g_insight(crowd: DataFrame) -> DataFrame:
    g5, everyone = F.count_if(F.col("network") == "G5"), F.count(F.lit(1))
    return crowd.agg(g5.alias("users_5g"), _share(g5, everyone).alias("share_5g"))


def crowd_commute_mean(crowd: DataFrame, medians: DataFrame) -> DataFrame:
    """Mean of the members' median commutes, per direction, as a whole number."""
    return (
        medians.join(crowd.select("imsi"), "imsi", "left_semi")
        .groupBy("direction")
        .agg(F.floor(F.avg("median_ms")).alias("mean_ms"))
    )


def head_density(crowd: DataFrame, area: float = SECTOR_AREA) -> DataFrame:
    """Users per unit of area; infinite when the area is (almost) zero."""
    density = F.col("users") / area if area > 1e-6 else F.lit(float("inf"))
    return headcount(crowd).withColumn("density", density)
