"""Documents dealt into chunks of bounded text, the unit in which tasks hash and mark words.

An exact count over all words or windows of a corpus needs one shuffle of small values.  Chunks
make it cheap: a task reduces the documents of a chunk to its distinct values first, sends them to
buckets by hash, and a bucket answers each chunk that sent a value.  A value found in a third of all
documents reaches its bucket once a chunk, not once a document.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: UTF-8 bytes of text in a chunk, about.
CHUNK_BYTES = 4_000_000


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def parts(total: float, each: float) -> int:
    return max(1, int(-(-total // each)))


def by_hash(count: int) -> Column:
    """Chunk by a hash of the id; rows without an id spread by their text."""
    key = F.coalesce(F.xxhash64(F.col("doc_id")), F.lit(0))
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(key)
    return F.pmod(spread, F.lit(count)).cast("int")


def by_range(docs: DataFrame, count: int) -> tuple[Column, int]:
    """Chunk by ranges of doc_id, so that an earlier chunk holds smaller ids only.

    Returns the chunk column and the first chunk of rows without an id.  Those rows spread over
    several chunks by their text.
    """
    edges: list[float] = []
    if count > 1:
        at = [i / count for i in range(1, count)]
        edges = docs.approxQuantile("doc_id", at, max(1e-4, 0.2 / count))
    # Edges are doubles; the largest one that is a 64-bit integer is 2**63 - 1024.
    bounds = np.unique(np.clip(np.array(edges, float), None, 2.0**63 - 1024).astype(np.int64))
    after = len(bounds) + 1

    @F.pandas_udf("int")
    def range_of(doc_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, doc_id.to_numpy(), side="right").astype("int32"))

    nameless = F.lit(after) + F.pmod(F.xxhash64("text"), F.lit(count)).cast("int")
    # A NULL would turn a batch of ids into doubles, which are not exact above 2**53.
    known = range_of(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)))
    return F.when(F.col("doc_id").isNull(), nameless).otherwise(known), after
