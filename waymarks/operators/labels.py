"""Crowd labels: drivers by movement features, professions by home, work and holiday places."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymarks.functions.calendar import SHANGHAI, Clock
from waymarks.functions.cells import site_of
from waymarks.operators.ordered import LIFETIME, Timeline
from waymarks.operators.traces import path_length

# ---- fixed values: labels and scene names as published, and the rules' numbers ------------
TAXI = "出租车司机"
BUS = "公交车司机"
COURIER = "快递人员"
EDUCATOR = "教务人员"
STUDENT = "学生"
DOCTOR = "医务工作者"
BUSINESS = "商务人员"
SCHOOL_SCENE = "学校"
HOSPITAL_SCENE = "医院"
ADULT_AGE = 23
BUSINESS_AGES = (18, 70)
BUSINESS_HOURS = (8, 20)
EDUCATOR_INCOME = 100
# ---- end of fixed values ------------------------------------------------------------------


def revisit_features(stays: DataFrame) -> DataFrame:
    """Stays per subscriber and mean repeat visits per day."""
    return (
        stays.groupBy("imsi", "date", "code")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("imsi", "date")
        .agg(F.sum("_n").alias("_stays"), (F.sum("_n") - F.count(F.lit(1))).alias("_repeats"))
        .groupBy("imsi")
        .agg(F.sum("_stays").alias("stays"), F.avg("_repeats").alias("mean_repeats"))
    )


def driver_labels_by_revisit(
    stays: DataFrame, min_stays: int, low: float, high: float
) -> DataFrame:
    """Few repeat visits taxi, medium courier, many bus; a mean on a cut-off gets no label."""
    mean = F.col("mean_repeats")
    label = (
        F.when(mean < low, TAXI)
        .when((mean > low) & (mean < high), COURIER)
        .when(mean > high, BUS)
    )
    return (
        revisit_features(stays)
        .where(F.col("stays") > min_stays)
        .withColumn("crowd_name", label)
        .where(F.col("crowd_name").isNotNull())
    )


@dataclass(frozen=True)
class DriverCuts:
    """Cut-offs of the five movement features."""

    distance: float = 300
    cells: float = 2
    visits: float = 2
    calls_per_cell: float = 2
    calls: float = 2


def movement_features(stays: DataFrame, line: Timeline = LIFETIME) -> DataFrame:
    """Trace length, distinct cells, visits per cell, calls and calls per called cell.

    ``called`` tells whether a stay has a call record.
    """
    keys = list(line.keys)
    per_cell = stays.groupBy(*keys, "code").agg(
        F.count(F.lit(1)).alias("_visits"), F.count_if("called").alias("_calls")
    )
    counts = per_cell.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cells"),
        F.avg("_visits").alias("visits"),
        F.sum("_calls").alias("calls"),
        F.coalesce(F.avg(F.when(F.col("_calls") > 0, F.col("_calls"))), F.lit(0.0)).alias(
            "calls_per_cell"
        ),
    )
    return path_length(stays, line).drop("manhattan_distance").join(counts, keys)


def driver_labels_by_features(
    stays: DataFrame, line: Timeline = LIFETIME, cuts: DriverCuts = DriverCuts()
) -> DataFrame:
    """Taxi, bus and courier drivers by strict comparison with the cut-offs."""
    roams = (F.col("distance") > cuts.distance) & (F.col("cells") > cuts.cells)
    seldom, often = F.col("visits") < cuts.visits, F.col("visits") > cuts.visits
    calls, per_cell = F.col("calls"), F.col("calls_per_cell")
    label = (
        F.when(roams & seldom & (calls > cuts.calls), TAXI)
        .when(
            roams & often & (per_cell < cuts.calls_per_cell) & (calls < cuts.calls), BUS
        )
        .when(
            roams & often & (per_cell > cuts.calls_per_cell) & (calls > cuts.calls), COURIER
        )
    )
    features = movement_features(stays, line).withColumn("crowd_name", label)
    return features.where(F.col("crowd_name").isNotNull())


def _exploded_labels(users: DataFrame, rules: dict[str, Column], keep: list[str]) -> DataFrame:
    """A row per user and rule that holds; NULL counts as not holding."""
    labels = F.filter(
        F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]),
        lambda n: n.isNotNull(),
    )
    return users.select(*keep, F.explode(labels).alias("crowd_name"))


def place_labels(
    users: DataFrame,
    areas: DataFrame,
    education_income: float,
    business_income: float,
) -> DataFrame:
    """Educators, students, doctors and business people by work, home and holiday cell.

    ``areas``: ``cell``, ``kind`` (school, hospital, business) and the area's ``name``.  A user can
    get more than one label.
    """
    named = areas.groupBy("cell").agg(
        *[
            F.min(F.when(F.col("kind") == kind, F.col("name"))).alias(kind)
            for kind in ("school", "hospital", "business")
        ]
    )
    for side in ("work", "home", "holiday"):
        at_side = named.select(
            F.col("cell").alias(f"{side}_cell"),
            *[F.col(k).alias(f"{side}_{k}") for k in ("school", "hospital", "business")],
        )
        users = users.join(at_side, f"{side}_cell", "left")
    work, home, holiday = (F.col(f"{s}_cell") for s in ("work", "home", "holiday"))
    known = (work != "") & (home != "")

    def site(cell: Column) -> Column:
        return F.coalesce(site_of(cell.try_cast("bigint")), F.lit(0))

    rules = {
        EDUCATOR: F.col("work_school").isNotNull()
        & known
        & F.when(home != work, F.col("holiday_school") != F.col("work_school")).otherwise(
            F.col("income") > education_income
        ),
        STUDENT: F.col("work_school").isNotNull()
        & F.col("home_school").isNotNull()
        & (F.col("age") < ADULT_AGE),
        DOCTOR: F.col("work_hospital").isNotNull()
        & ~F.col("work_hospital").eqNullSafe(F.col("home_hospital"))
        & (site(work) != site(home))
        & (site(work) != site(holiday)),
        BUSINESS: F.col("work_business").isNotNull()
        & F.col("age").between(*BUSINESS_AGES)
        & (site(work) != site(home))
        & (F.col("income") > business_income),
    }
    return _exploded_labels(users, rules, ["imsi", "phone", "imei"])


def place_labels_weekend(
    stays: DataFrame,
    users: DataFrame,
    scenes: DataFrame,
    clock: Clock = SHANGHAI,
    education_income: float = EDUCATOR_INCOME,
) -> DataFrame:
    """Educators, students, doctors and business people by the scenes of home and work cell
    and by where they are at weekends and in business hours.

    ``scenes``: ``cell`` and ``scene``.  Stays are counted per subscriber and cell before they meet
    the subscribers.
    """
    weekend = clock.is_rest_day(F.col("s_time"))
    office_time = (clock.hour(F.col("s_time")) >= BUSINESS_HOURS[0]) & (
        clock.hour(F.col("e_time")) <= BUSINESS_HOURS[1]
    )
    per_cell = stays.groupBy("imsi", "code").agg(
        F.count_if(weekend).alias("_weekend"),
        F.count_if(office_time).alias("_inside"),
        F.count_if(~office_time).alias("_outside"),
    )
    at_work = F.col("code") == F.col("work_cell")
    counts = (
        per_cell.join(users.select("imsi", "work_cell"), "imsi")
        .groupBy("imsi")
        .agg(
            F.sum(F.when(at_work, F.col("_weekend")).otherwise(0)).alias("_weekend_on"),
            F.sum(F.when(at_work, 0).otherwise(F.col("_weekend"))).alias("_weekend_off"),
            F.sum(F.when(at_work, F.col("_inside")).otherwise(0)).alias("_inside"),
            F.sum(F.when(at_work, F.col("_outside")).otherwise(0)).alias("_outside"),
        )
    )
    for side in ("home", "work"):
        users = users.join(
            scenes.select(F.col("cell").alias(f"{side}_cell"), F.col("scene").alias(f"{side}_scene")),
            f"{side}_cell",
            "left",
        )
    users = users.join(counts, "imsi")
    home, work, age = F.col("home_scene"), F.col("work_scene"), F.col("age")
    known = home.isNotNull() & work.isNotNull()
    mostly_away = F.col("_weekend_off") > F.col("_weekend_on")
    rules = {
        EDUCATOR: known
        & (work == SCHOOL_SCENE)
        & (age > ADULT_AGE)
        & F.when(home != work, mostly_away).otherwise(F.col("income") > education_income),
        STUDENT: (work == SCHOOL_SCENE) & (age < ADULT_AGE),
        DOCTOR: known
        & (work == HOSPITAL_SCENE)
        & (age > ADULT_AGE)
        & (home != work)
        & mostly_away,
        BUSINESS: known
        & age.between(*BUSINESS_AGES)
        & (home != work)
        & (F.col("_inside") > F.col("_outside")),
    }
    return _exploded_labels(users, rules, ["imsi", "phone", "imei"])


def published_labels(labels: DataFrame, subscribers: DataFrame, stat_date: str) -> DataFrame:
    """Labels as the published table: imsi, msisdn, imei, crowd_name, stat_date; blank where unknown."""
    known = subscribers.groupBy("imsi").agg(F.min(F.struct("phone", "imei")).alias("_user"))
    blank = F.lit("")
    return labels.select("imsi", "crowd_name").join(known, "imsi", "left").select(
        "imsi",
        F.coalesce("_user.phone", blank).alias("msisdn"),
        F.coalesce("_user.imei", blank).alias("imei"),
        "crowd_name",
        F.lit(stat_date).alias("stat_date"),
    )
