"""Dimensions of cells: one row for each cell, and what contradicts it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What ``cell_number`` makes of an unreadable cell; it names no cell.
NO_CELL = "0"


def one_row_per_cell(dim: DataFrame, keys: tuple[str, ...] = ("code", "rat")) -> DataFrame:
    """The dimension with one row for each key, so that a join on it keeps the number of rows.

    Of rows that contradict each other the smallest, compared column by column, stays; see
    ``cell_conflicts``.  Rows without a readable code go.
    """
    rest = [c for c in dim.columns if c not in keys]
    if not rest:
        return dim.where(_readable()).distinct()
    kept = dim.where(_readable()).groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in dim.columns])


def cell_conflicts(dim: DataFrame, keys: tuple[str, ...] = ("code", "rat")) -> DataFrame:
    """Keys with rows that contradict each other: how many rows, the one that stays and the largest."""
    rest = F.struct(*[c for c in dim.columns if c not in keys])
    return (
        dim.where(_readable())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"), F.min(rest).alias("kept"), F.max(rest).alias("other"))
        .where(F.col("kept") != F.col("other"))
    )


def _readable():
    return F.col("code").isNotNull() & (F.col("code") != NO_CELL)


def cell_keys(rows: DataFrame, dim: DataFrame) -> list[str]:
    """Join by code and technology where both sides have it: codes of 2G and 4G cells can be equal."""
    return ["code", "rat"] if {"rat"} <= set(rows.columns) & set(dim.columns) else ["code"]
