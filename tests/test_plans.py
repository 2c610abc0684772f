"""How often plans read and shuffle, and how evenly they deal a hot trace."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from waymarks.operators import clean, od
from waymarks.operators import stays as S
from waymarks.operators.ordered import DAILY, annotate, neighbours

KEEP = {
    "spark.sql.shuffle.partitions": "200",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def counted(df):
    """Scans and shuffles of rows by slice in the plan that ran; reused ones count once."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = plan.splitlines()
    return {
        "scans": sum("FileScan" in x for x in lines),
        "by_slice": len([x for x in lines if re.search(r"Exchange hashpartitioning\(_trace_\w+_hash#\w+, _slice", x) and "Reused" not in x]),
        "shuffles": sum("Exchange hashpartitioning" in x and "Reused" not in x for x in lines),
        "joins": sum("Join" in x for x in lines),
    }


@pytest.fixture(scope="module")
def points(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("points") / "p")
    df = spark.range(4000).select(
        (F.col("id") % 40).cast("string").alias("imsi"),
        F.lit("d").alias("date"),
        F.col("id").alias("event_id"),
        (F.col("id") * 977 % 86_400_000).alias("s_time"),
        (F.col("id") * 977 % 86_400_000 + 5000).alias("e_time"),
        (F.col("id") % 7).cast("string").alias("code"),
        (105 + F.col("id") % 10 / 100).alias("lon"),
        (26 + F.col("id") % 10 / 100).alias("lat"),
        F.lit("ROAD").alias("scene"),
        F.lit(6).alias("rat"),
        F.when(F.col("id") % 3 == 0, "MR").otherwise("XDR").alias("source"),
    )
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_one_scan_and_one_shuffle_by_slice(points):
    stays = counted(S.stay_aggregate(points))
    assert (stays["scans"], stays["by_slice"], stays["shuffles"], stays["joins"]) == (1, 1, 2, 0)
    merged = counted(S.merge_adjacent_stays(points, smooth=True))
    assert (merged["scans"], merged["by_slice"], merged["shuffles"], merged["joins"]) == (1, 1, 2, 0)
    near = counted(neighbours(points, before={"was": F.col("code")}, after={"then": F.col("code")}))
    assert (near["scans"], near["by_slice"], near["shuffles"], near["joins"]) == (1, 1, 2, 0)


def test_a_chain_of_annotations_reads_once(points):
    rows = annotate(points, last_upto={"known": F.when(F.col("code") == "3", F.col("code"))})
    rows = annotate(rows, run_of=F.col("known"), position="pos")
    rows = annotate(rows, anywhere={"indoor": F.col("scene") == "INDOOR"})
    found = counted(DAILY.unsliced(rows))
    assert found["scans"] == 1


def test_changes_of_place_read_once(points):
    placed = S.stay_aggregate(points).withColumns(
        {"place_code": F.col("code"), "place_name": F.col("code"), "place_scene": F.lit("")}
    )
    found = counted(od.od_changes(placed))
    assert (found["scans"], found["by_slice"], found["joins"]) == (1, 2, 0)


def test_whole_trace_flag_reads_once(points):
    found = counted(clean.drop_bad_coordinate_traces(points))
    assert (found["scans"], found["by_slice"]) == (1, 1)


def test_a_million_rows_in_an_hour_are_many_tasks(spark):
    n = 1_000_000
    rows = spark.range(n).select(
        F.lit(None).cast("string").alias("imsi"),
        F.lit("d").alias("date"),
        F.col("id").alias("event_id"),
        F.floor(F.col("id") * 3.6).alias("s_time"),
        F.floor(F.col("id") * 3.6 + 5000).alias("e_time"),
        F.floor(F.col("id") / 300).cast("string").alias("code"),
    )
    before = {k: spark.conf.get(k) for k in KEEP}
    try:
        for k, v in KEEP.items():
            spark.conf.set(k, v)
        dealt = DAILY.sliced(rows).repartition(*DAILY.here)
        largest = dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert largest <= 0.02 * n
        got = S.merge_adjacent_stays(rows, smooth=True, midpoint=False)
        one = S.merge_adjacent_stays(rows, replace(DAILY, slice_ms=10**15), smooth=True, midpoint=False)
        columns = ["event_id", "code", "s_time", "e_time"]
        assert got.select(columns).exceptAll(one.select(columns)).count() == 0
        assert got.count() == one.count() == 3334
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
