"""Joins of intervals that overlap, and joins whose keys have very many rows on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymarks.functions.calendar import DAY_MS, HOUR_MS

#: Longest interval that is dealt to buckets; a longer one is a fault of its row.
LONGEST_MS = 400 * DAY_MS


def broken_intervals(df: DataFrame, start: str, end: str, longest_ms: int = LONGEST_MS) -> DataFrame:
    """Rows that ``overlap_join`` leaves out, with the ``reason``: no time, negative or too long."""
    return df.withColumn("reason", _reason(start, end, longest_ms)).where(F.col("reason").isNotNull())


def whole_intervals(df: DataFrame, start: str, end: str, longest_ms: int = LONGEST_MS) -> DataFrame:
    """The rows that are not ``broken_intervals``."""
    return df.where(_reason(start, end, longest_ms).isNull())


def _reason(start: str, end: str, longest_ms: int):
    length = F.try_subtract(F.col(end), F.col(start))
    return (
        F.when(F.col(start).isNull() | F.col(end).isNull(), "no time")
        .when(F.col(end) < F.col(start), "ends before it starts")
        .when(length.isNull() | (length > longest_ms), "too long")
    )


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    on: tuple[str, ...] = (),
    bucket_ms: int = HOUR_MS,
    longest_ms: int = LONGEST_MS,
) -> DataFrame:
    """Pairs of rows whose intervals [start, end) overlap, and that agree in ``on``.

    Both sides are dealt to the time buckets they touch and joined on equal buckets; a pair is judged in
    the first bucket that both touch, so it comes once.  Columns other than ``on`` have different
    names on both sides.  Rows of ``broken_intervals`` have no partner.
    """

    def dealt(df: DataFrame, span: tuple[str, str], first: str) -> DataFrame:
        start, end = span
        a = F.floor(F.col(start) / F.lit(bucket_ms))
        # An interval without length overlaps what lies around its start.
        b = F.floor(F.greatest(F.col(start), F.col(end) - 1) / F.lit(bucket_ms))
        whole = whole_intervals(df, start, end, longest_ms)
        return whole.withColumn(first, a).withColumn("_bucket", F.explode(F.sequence(a, b)))

    met = dealt(left, left_span, "_first_left").join(
        dealt(right, right_span, "_first_right"), [*on, "_bucket"]
    )
    (s1, e1), (s2, e2) = left_span, right_span
    overlap = (F.col(s1) < F.col(e2)) & (F.col(e1) > F.col(s2))
    first = F.col("_bucket") == F.greatest("_first_left", "_first_right")
    return met.where(first & overlap).drop("_bucket", "_first_left", "_first_right")


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, ...],
    left_counted: DataFrame | None = None,
    rows: int = 4096,
) -> DataFrame:
    """Inner equality join that deals the pairs of a hot key over many tasks.

    The rows of a key are cut, on each side by a hash of the whole row, into pieces of about ``rows``, and
    each piece meets each piece of the other side.  A row is copied once per piece it meets, so copies
    are a few thousandths of the pairs.  The number of partitions is given, because the size of the
    input, by which Spark would choose it, says little about the number of pairs.  ``left_counted`` may
    stand in for ``left`` where rows per key, or a bound of them, are cheaper to count.
    """
    known = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()

    def pieces(df: DataFrame, name: str) -> DataFrame:
        found = df.where(known).groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
        return found.select(*on, F.ceil(F.col("_rows") / F.lit(rows)).alias(name))

    sizes = pieces(left if left_counted is None else left_counted, "_lefts").join(
        pieces(right, "_rights"), list(on)
    )
    spark = left.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unit = [*on, "_left", "_right"]

    def dealt(df: DataFrame, mine: str, own: str, others: str, other: str) -> DataFrame:
        hashed = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        sized = df.where(known).withColumn("_hash", F.xxhash64(*hashed)).join(sizes, list(on))
        return (
            sized.withColumn(mine, F.pmod("_hash", own))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(others) - 1)))
            .drop("_hash", "_lefts", "_rights")
            .repartition(parts, *unit)
        )

    met = dealt(left, "_left", "_lefts", "_rights", "_right").join(
        dealt(right, "_right", "_rights", "_lefts", "_left"), unit
    )
    return met.drop("_left", "_right")
