"""Every way of slicing a trace gives what a plain walk over its rows gives."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from waymarks.operators.ordered import Timeline, annotate, exact_median

KEYS, SLICE = ("imsi",), 10


def rows(seed):
    rng = random.Random(seed)
    out, n = [], 0
    for imsi, count in (("a", 60), ("b", 7), ("c", 1), (None, 12), ("d", 25)):
        for _ in range(count):
            n += 1
            out.append(
                (imsi, rng.randrange(200), n, rng.choice("xxyz"), rng.choice([None, None, 1, 2]))
            )
    return out


def walk(data):
    """Expected columns by event_id."""
    want = {}
    for imsi in {r[0] for r in data}:
        trace = sorted((r for r in data if r[0] == imsi), key=lambda r: (r[1], r[2]))
        known, run = None, None
        for i, r in enumerate(trace):
            before = trace[i - 1] if i else None
            after = trace[i + 1] if i + 1 < len(trace) else None
            if before is None or before[3] != r[3]:
                run = r[2]
            row = {
                "prev": before and before[3],
                "prev_t": before and before[1],
                "next_t": after and after[1],
                "known_before": known,
                "pos": i + 1,
                "n": len(trace),
                "run_id": run,
            }
            known = r[4] if r[4] is not None else known
            row["known_upto"] = known
            want[r[2]] = row
    return want


def lines():
    base = Timeline(keys=KEYS, slice_ms=SLICE)
    return {
        "slices": base,
        "one slice": replace(base, slice_ms=10**6),
        "a slice for each stamp": replace(base, slice_ms=1),
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_annotate_equals_walk(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame(
        data, "imsi string, s_time long, event_id long, code string, v int"
    )
    want = walk(data)
    for name, line in lines().items():
        got = annotate(
            df,
            line,
            before={"prev": F.col("code"), "prev_t": F.col("s_time")},
            after={"next_t": F.col("s_time")},
            last_before={"known_before": F.col("v")},
            last_upto={"known_upto": F.col("v")},
            run_of=F.col("code"),
            position="pos",
            size="n",
        ).withColumn("run_id", F.col("run.event_id"))
        found = {r["event_id"]: {k: r[k] for k in want[1]} for r in got.collect()}
        assert found == want, name


def test_equal_stamps_keep_their_runs(spark):
    data = [("a", 5, 1, c, None) for c in "BAB"] + [(None, 5, 1, "C", None), (None, 5, 1, "A", None)]
    df = spark.createDataFrame(data, "imsi string, s_time long, event_id long, code string, v int")
    for line in lines().values():
        got = annotate(df, line, run_of=F.col("code"), before={"prev": F.col("code")})
        got = {(r["imsi"], r["code"], r["prev"], tuple(r["run"])) for r in got.collect()}
        assert got == {
            ("a", "A", None, (5, 1, "A")),
            ("a", "B", "A", (5, 1, "B")),
            ("a", "B", "B", (5, 1, "B")),
            (None, "A", None, (5, 1, "A")),
            (None, "C", "A", (5, 1, "C")),
        }


def test_rows_without_key_are_sliced_too(spark):
    df = spark.createDataFrame(
        [(None, t, t, "A", None) for t in range(0, 100, 5)],
        "imsi string, s_time long, event_id long, code string, v int",
    )
    got = annotate(df, lines()["slices"], position="pos", size="n")
    assert got.select(lines()["slices"].slice).distinct().count() == 10
    assert sorted((r["pos"], r["n"]) for r in got.collect()) == [(i + 1, 20) for i in range(20)]


def test_exact_median(spark):
    rng = random.Random(5)
    data = [(k, rng.randrange(0, 500_000)) for k in "pqr" for _ in range(rng.randrange(1, 60))]
    df = spark.createDataFrame(data, "k string, v long")
    for width in (7, 60_000):
        got = {r["k"]: r["median"] for r in exact_median(df, ["k"], "v", bin_width=width).collect()}
        for k in "pqr":
            values = sorted(v for key, v in data if key == k)
            n = len(values)
            assert got[k] == (values[(n - 1) // 2] + values[n // 2]) / 2
