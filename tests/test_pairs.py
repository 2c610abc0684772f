"""Joins with many rows on both sides of a key: right pairs, none shuffled twice, hot keys on many tasks."""

import random

from pyspark.sql import functions as F

from waymarks.operators import clean, crowds, traces
from waymarks.operators.intervals import spread_join

H = 3_600_000


def above_join(df):
    """Names of the operators that the pairs go through."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = [line for line in plan.splitlines()[1:] if line.strip()]
    first = next(i for i, line in enumerate(lines) if "Join" in line)
    return "\n".join(lines[:first])


def test_lingering_users_come_once_without_a_shuffle_of_pairs(spark):
    dice = random.Random(3)

    def span(longest):
        s = dice.choice([dice.randrange(0, 9 * H), dice.randrange(0, 9) * H])
        return s, s + dice.choice([0, 1, dice.randrange(longest), H])

    stays = [(dice.choice([None, "u", "v", "w"]), dice.choice("AB"), *span(4 * H)) for _ in range(120)]
    stays += stays[:20] + [("x", None, 0, H), ("x", "A", None, H), ("x", "A", H, 0), ("x", "A", 0, 10**14)]
    windows = [(i, dice.choice("AB"), *span(2 * H)) for i in range(60)]
    windows += windows[:5] + [(100, None, 0, H), (101, "A", H, 0)]
    df = spark.createDataFrame(stays, "imsi string, code string, s_time long, e_time long")

    def check(rows):
        got = crowds.linger_crowds(df, spark.createDataFrame(rows, "window long, code string, start long, end long"))
        want = {
            (w, i) for w, c, f, u in rows for i, code, s, e in stays
            if c and c == code and None not in (s, e) and 0 <= e - s < 10**13 and f <= u and s < u and e > f
        }
        pairs = [tuple(r) for r in got.collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want
        return got

    assert "Exchange" not in above_join(check(windows))
    # Windows with several spans or codes, also under no name.
    check(windows + [(i % 7 or None, dice.choice("AB"), *span(2 * H)) for i in range(40)])


def test_places_meet_sums_of_stays_and_pairs_are_not_shuffled(spark):
    dice = random.Random(4)
    spots = [(105.0, 26.0), (105.5, 26.0), (0.0, -0.0), (None, 26.0)]
    stays = [(dice.choice(["u", "v", None]), "d", *dice.choice(spots), dice.choice([5, 7, None])) for _ in range(80)]
    df = spark.createDataFrame(stays, "imsi string, date string, lon double, lat double, duration long")
    places = [(f"p{i}", *spots[i % 4]) for i in range(12)]
    places += places[:3] + [(None, *spots[0])]

    def check(rows):
        there = spark.createDataFrame(rows, "place string, lon double, lat double")
        counts, times = {}, {}
        for i, d, x, y, t in stays:
            for p, px, py in rows:
                if None not in (x, y) and (x, y) == (px, py):
                    counts[i, d, p] = counts.get((i, d, p), 0) + 1
                    times.setdefault((i, d, p), []).extend([] if t is None else [t])
        passed, spent = traces.trace_passby_count(df, there), traces.total_time_by_coord(df, there)
        assert {tuple(r)[:3]: r.passes for r in passed.collect()} == counts
        assert {tuple(r)[:3]: r.total_ms for r in spent.collect()} == {k: sum(v) if v else None for k, v in times.items()}
        assert passed.count() == spent.count() == len(counts)
        return passed, spent

    for got in check(places):
        assert "Exchange" not in above_join(got)
    check(places + [("p1", *spots[0]), ("p1", *spots[2]), (None, *spots[1])])


def test_a_hot_key_is_met_in_many_tasks(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        left = spark.range(300).select(F.when(F.col("id") < 290, "hot").otherwise("b").alias("k"), F.col("id").alias("l"))
        right = spark.range(100).select(F.when(F.col("id") < 95, "hot").otherwise("c").alias("k"), F.col("id").alias("r"))
        rows = spread_join(left, right, ("k",), rows=10).withColumn("task", F.spark_partition_id()).collect()
        assert sorted((r.l, r.r) for r in rows) == [(a, b) for a in range(290) for b in range(95)]
        tasks = [sum(r.task == t for r in rows) for t in {r.task for r in rows}]
        assert max(tasks) < 0.5 * len(rows)

        lon, lat = F.lit(105.0) + F.col("id") * 1e-12, F.lit(26.0) + F.col("id") * 1e-12
        cells = spark.range(30_000).select(F.col("id").alias("eci"), lon.alias("lon"), lat.alias("lat"))
        places = spark.range(3).select(F.concat(F.lit("p"), "id").alias("place"), lon.alias("lon"), lat.alias("lat"))
        near = clean.cells_near_places(cells, places, 3000).select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
        assert sum(r["count"] for r in near) == 90_000 and len(near) > 1
    finally:
        spark.conf.set(key, before)
