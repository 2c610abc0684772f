"""Tables that cut lineage, written to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a new one only for a local master without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def write(df: DataFrame, name: str, by: tuple[str, ...] = (), **options: object) -> str:
    """Path of the rows of ``df``, written once as Parquet, in a folder for each value of ``by``."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    out = df.write.options(**options)
    (out.partitionBy(*by) if by else out).parquet(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once as Parquet and read back."""
    return df.sparkSession.read.schema(df.schema).parquet(write(df, name))
