"""From raw documents to a training mix, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``.  All but the last return the columns of ``docs``.

1. ``language``: documents whose language prediction is rejected go.
2. ``near_duplicates``: one document of each group of near copies stays.
3. ``decontamination``: documents that hold passages of the benchmark go.
4. ``secrets``: secrets in texts are replaced by a mark; n_chars follows.
5. ``mix``: the words that a mix of the sources takes of each document.

An empty table passes through every stage.  NULL texts are rejected by the first.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymarks.llm import decontaminate, langid, minhash, mixing
from waymarks.llm import secrets as secret_scan
from waymarks.llm.stored import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))
    return decontaminate.keep_clean(docs, benchmark)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = secret_scan.redact(docs)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", length)
    return out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target and the words taken of each document."""
    return mixing.Mix(docs).taken()


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mix", mix),
]

#: Trained, hashed and shuffled stages have no SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
