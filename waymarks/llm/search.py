"""Exact ranked search: bundles of items pass the owners of their terms, stage after stage.

Documents are cut into shards, terms into stages by how many documents hold them, rarest first.  An
owner holds the postings of one stage's terms in one shard.  A bundle of items starts empty; at each
stage it is brought together with the owner of its next terms by cogroup, adds their integer
contributions to its sparse accumulators of documents, and goes on.  Behind the last stage it gives
its best documents of the shard, of which a window takes the best of all.

An accumulator goes early only if its sum and the most that the later terms can add stay below the
``top``-th sum of its item in the shard; it could then not be among the best, so the result is exact.

Postings are made for terms that may be in an item: a bitmap of ``SLOTS`` bits, whatever the number of
items, holds their hashes.  Other terms in a slot are sorted out by the join with the items' terms.

Defined results: NULL text has no terms.  Equal rows of the items count once; rows with one item_id and
different texts are ranked each for itself.  Repeated documents are ranked each; a NULL doc_id
comes after all others of its score.  Items without a scoring document have no rows.  Empty tables
give an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from waymarks.llm.chunks import parts
from waymarks.llm.stored import stored
from waymarks.llm.terms import Terms, byte_table, shards, sort_pointers

#: Bits of the bitmap of item terms: 128 KB.
SLOTS = 1 << 20
#: Share of the documents with terms that a term may be in, for each stage but the last.
STAGES = (0.001, 0.01, 0.1)
#: Items of a bundle, and documents of a shard at most: their product bounds the sums in one task.
BUNDLE = 64
SHARD_DOCS = 4096

POSTINGS = (
    "shard bigint, term string, df bigint, most bigint, docs binary, ratio binary, ids array<bigint>"
)
STATE = "bundle int, shard bigint, item array<bigint>, size array<int>, docs binary, sums binary"
FOUND = "item bigint, shard bigint, doc int, score bigint"

_POSTINGS = pa.schema(
    [("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("most", pa.int64())]
    + [("docs", pa.binary()), ("ratio", pa.binary()), ("ids", pa.list_(pa.int64()))]
)


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    for shard in shards(batches):
        for at in range(0, len(shard), most):
            yield shard.slice(at, most)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = byte_table(digits=True)
    for shard in shards(batches):
        counts = Terms(shard["text"], table).counts
        sums = [pa.array([int((counts > 0).sum())]), pa.array([int(counts.sum())])]
        yield pa.record_batch(sums, names=["docs", "terms"])


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = byte_table(digits=True)
    for batch in batches:
        terms = Terms(pa.table([batch["text"]], ["text"])["text"], table)
        raw = terms.data.tobytes()
        texts = [raw[i : i + n] for i, n in zip(terms.start.tolist(), terms.length.tolist())]
        slots = [xxhash.xxh3_64_intdigest(t) % SLOTS for t in texts]
        yield pa.record_batch(
            [
                batch["item"].take(pa.array(terms.doc)),
                pa.array([t.decode("utf-8") for t in texts], pa.string()),
                pa.array(slots, pa.int32()),
            ],
            names=["item", "term", "slot"],
        )


def _binary(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Cut ``values`` at ``first`` into one binary value each."""
    offsets = (np.append(first, len(values)) * values.itemsize).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(first), buffers)


def _postings(n_docs: int, n_terms: int, bitmap: bytes, shard_docs: int):
    """Rows of one shard: postings of a term, and one row with the ids of its documents."""
    table = byte_table(digits=True)
    wanted = np.unpackbits(np.frombuffer(bitmap, np.uint8)).view(bool)

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for shard in _cut(batches, shard_docs):
            # Documents in order of their id, so that a smaller number is a smaller id.
            shard = shard.take(pc.sort_indices(shard, [("doc_id", "ascending")]))
            ids = pa.array([shard["doc_id"].to_pylist()], pa.list_(pa.int64()))
            none = pa.nulls(1, pa.binary())
            head = [pa.array([at]), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64())]
            yield pa.record_batch([*head, pa.nulls(1, pa.int64()), none, none, ids], schema=_POSTINGS)
            terms = Terms(shard["text"], table)
            length = 25 + (75 * terms.counts.astype(np.int64) * n_docs) // max(n_terms, 1)
            order, new = sort_pointers(terms.data, terms.start, terms.length)
            shown = order[new]
            raw = terms.data.tobytes()
            texts = [
                raw[i : i + n]
                for i, n in zip(terms.start[shown].tolist(), terms.length[shown].tolist())
            ]
            digest = xxhash.xxh3_64_intdigest
            slot = np.fromiter((digest(t) % SLOTS for t in texts), np.int64, len(texts))
            asked = wanted[slot]
            term = np.cumsum(new) - 1
            stays = asked[term]
            doc, term = terms.doc[order[stays]], term[stays]
            first = np.ones(len(doc), bool)
            first[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
            place = np.flatnonzero(first)
            tf = np.diff(np.append(place, len(doc)))
            doc, term = doc[place], term[place]
            ratio = (1_000_000_000 * tf) // (1000 * tf + 8 * length[doc])
            begin = np.flatnonzero(np.diff(term, prepend=-1))
            n = len(begin)
            if n:
                shown_terms = [texts[i].decode("utf-8") for i in term[begin].tolist()]
                columns = [
                    pa.array([at] * n, pa.int64()),
                    pa.array(shown_terms, pa.string()),
                    pa.array(np.diff(np.append(begin, len(doc))), pa.int64()),
                    pa.array(np.maximum.reduceat(ratio, begin), pa.int64()),
                    _binary(doc.astype(np.uint16), begin),
                    _binary(ratio.astype(np.uint32), begin),
                    pa.nulls(n, pa.list_(pa.int64())),
                ]
                yield pa.record_batch(columns, schema=_POSTINGS)
            at += 1

    return posted


class Sums:
    """The accumulators of a bundle in one shard."""

    def __init__(self, state: pd.DataFrame, size: int):
        self.size = size
        self.of: dict[int, np.ndarray] = {}
        for row in state.itertuples():
            ends = np.cumsum(row.size)[:-1]
            docs = np.split(np.frombuffer(row.docs, np.uint16), ends)
            sums = np.split(np.frombuffer(row.sums, np.int64), ends)
            for item, d, s in zip(row.item, docs, sums):
                self.item(int(item))[d] = s

    def item(self, key: int) -> np.ndarray:
        if key not in self.of:
            self.of[key] = np.zeros(self.size, np.int64)
        return self.of[key]

    def add(self, owner: pd.DataFrame) -> dict[int, int]:
        """Add the contributions of an owner's terms; the most that later stages add by item."""
        rest: dict[int, int] = {}
        for row in owner.itertuples():
            docs = np.frombuffer(row.docs, np.uint16)
            worth = np.frombuffer(row.ratio, np.uint32).astype(np.int64) * row.weight
            for asked in row.items:
                self.item(asked["item"])[docs] += worth * asked["times"]
                rest[asked["item"]] = asked["rest"]
        return rest

    def best(self, top: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for key, sums in self.of.items():
            docs = np.flatnonzero(sums)
            docs = docs[np.argsort(-sums[docs], kind="stable")[:top]]
            yield key, docs, sums[docs]


def _stage(top: int, shard_docs: int, last: bool):
    def stage(key: tuple, state: pd.DataFrame, owner: pd.DataFrame) -> pd.DataFrame:
        bundle, shard = key
        sums = Sums(state, shard_docs)
        rest = sums.add(owner)
        if last:
            found = [
                (item, shard, int(d), int(s))
                for item, docs, scores in sums.best(top)
                for d, s in zip(docs, scores)
            ]
            return pd.DataFrame(found, columns=["item", "shard", "doc", "score"])
        items, sizes, docs, values = [], [], [], []
        for item, own in sums.of.items():
            at = np.flatnonzero(own)
            if item in rest and len(at) > top:
                least = np.partition(own[at], -top)[-top]
                at = at[own[at] + rest[item] >= least]
            items.append(item)
            sizes.append(len(at))
            docs.append(at.astype(np.uint16))
            values.append(own[at])
        none = np.zeros(0, np.int64)
        row = (
            bundle,
            shard,
            items,
            sizes,
            np.concatenate(docs or [none.astype(np.uint16)]).tobytes(),
            np.concatenate(values or [none]).tobytes(),
        )
        return pd.DataFrame([row], columns=["bundle", "shard", "item", "size", "docs", "sums"])

    return stage


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = 10,
    stages: tuple[float, ...] = STAGES,
    bundle: int = BUNDLE,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """The ``top`` documents of each item by score: item_id, rank, doc_id, score.

    ``shard_docs`` is at most 65,536.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    n_docs, n_terms = (
        texts.select("text").mapInArrow(_sizes, "docs bigint, terms bigint")
        .agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0)))
        .first()
    )
    named = (
        items.select("item_id", "text").distinct()
        .withColumn("item", F.xxhash64("item_id", "text"))
    )
    asked = named.select("item", "text").mapInArrow(_item_terms, "item bigint, term string, slot int")
    bundles = parts(named.count(), bundle)

    # At most SLOTS numbers, however many terms the items have.
    bits = np.zeros(SLOTS, bool)
    for row in asked.select("slot").distinct().toLocalIterator():
        bits[row.slot] = True
    post = _postings(n_docs, n_terms, np.packbits(bits).tobytes(), shard_docs)
    posted = stored(texts.mapInArrow(post, POSTINGS), "postings")
    postings = posted.where(F.col("term").isNotNull())

    stage = F.lit(len(stages))
    for i, share in reversed(list(enumerate(stages))):
        stage = F.when(F.col("docs_with") <= share * n_docs, F.lit(i)).otherwise(stage)
    inverse = (2 * n_docs + 2) / (2 * F.col("docs_with").cast("double") + 1)
    weights = (
        postings.groupBy("term")
        .agg(F.sum("df").alias("docs_with"), F.max("most").alias("most"))
        .withColumns({"weight": F.floor(1000 * F.log(inverse)), "stage": stage})
    )
    wanted = (
        asked.groupBy("item", "term").agg(F.count(F.lit(1)).alias("times")).join(weights, "term")
    )
    later = Window.partitionBy("item").orderBy("stage")
    all_of = F.sum(F.col("times") * F.col("weight") * F.col("most"))
    wanted = wanted.withColumn(
        "rest",
        all_of.over(Window.partitionBy("item"))
        - all_of.over(later.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
    )
    wanted = wanted.groupBy(
        F.pmod("item", F.lit(bundles)).cast("int").alias("bundle"), "term", "stage", "weight"
    ).agg(F.collect_list(F.struct("item", "times", "rest")).alias("items"))
    wanted = stored(wanted, "item-terms")

    state = spark.createDataFrame([], STATE)
    for i in range(len(stages) + 1):
        owners = postings.select("term", "shard", "docs", "ratio").join(
            wanted.where(F.col("stage") == i).drop("stage"), "term"
        )
        last = i == len(stages)
        state = (
            state.groupBy("bundle", "shard")
            .cogroup(owners.groupBy("bundle", "shard"))
            .applyInPandas(_stage(top, shard_docs, last), FOUND if last else STATE)
        )
    ids = posted.where(F.col("ids").isNotNull()).select("shard", F.posexplode("ids").alias("doc", "doc_id"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = (
        state.join(ids, ["shard", "doc"])
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
    )
    return best.join(named.select("item", "item_id"), "item").select(
        "item_id", "rank", "doc_id", "score"
    )
