"""Writers of partitioned tables and text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymarks.operators.clean import to_string_row


def write_partition_overwrite(
    df: DataFrame, path: str, partitions: tuple[str, ...] = ("day_id",), fmt: str = "parquet"
) -> None:
    """Replace the partitions that ``df`` has rows for and leave the others as they are.

    Rows of a partition value are brought together so that it gets few files; a value with
    very many rows is split over several tasks by the rebalance.
    """
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .format(fmt)
        .save(path)
    )


def write_text_replace(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Text lines of all columns, replacing the folder."""
    line = F.concat_ws(sep, *to_string_row(df).columns)
    to_string_row(df).select(line.alias("value")).write.mode("overwrite").text(path)
