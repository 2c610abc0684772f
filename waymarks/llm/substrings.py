"""Exact substring dedup: Rabin-Karp hashes of every window of consecutive words.

Every window of ``width`` words of every document is hashed.  Chunks of documents (ranges of doc_id)
send their distinct hashes to buckets, where Spark brings equal hashes together; a bucket answers
each chunk, except the first, that holds a window of an earlier chunk.  A chunk then marks the words
of windows that an earlier chunk or an earlier document of its own holds, and merges marked
windows into maximal intervals.  The bucket is chosen by a second rolling hash, so that two windows
count as equal only if 64 bits and the bucket agree.

Defined results: NULL text has no words.  A NULL doc_id counts as larger than every id.  Rows with
one doc_id (repeated rows, or NULL) never remove words of each other.  Documents with fewer words
than a window keep all.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymarks.llm.chunks import CHUNK_BYTES, by_range, parts, text_bytes
from waymarks.llm.hashing import BASE_A, BASE_B, WordHashes, pack, rolling, unpack, words_of

#: Text bytes whose windows one bucket receives, about.
BUCKET_BYTES = 12_000_000

SENT = "chunk int, rank int, bucket int, hashes binary"
KEPT = (
    "doc_id bigint, n_words bigint, n_removed bigint, "
    "removed array<struct<start:bigint,end:bigint>>, text string"
)


class Windows:
    """Hashes of all windows of a chunk; windows do not cross documents."""

    def __init__(self, texts: list[str | None], width: int, buckets: int):
        hashes = WordHashes()
        self.words = [words_of(t) for t in texts]
        self.ends = np.cumsum([len(w) for w in self.words], dtype=np.int64)
        self.starts = self.ends - [len(w) for w in self.words]
        tokens = [hashes.array(w) for w in self.words]
        tokens = np.concatenate(tokens) if tokens else np.empty(0, np.uint64)
        left = np.maximum(self.ends - self.starts - width + 1, 0)
        self.doc = np.repeat(np.arange(len(texts)), left)
        first = np.cumsum(left) - left
        self.at = np.arange(left.sum()) - np.repeat(first - self.starts, left)
        self.hash = rolling(tokens, width, BASE_A)[self.at]
        other = rolling(tokens, width, BASE_B)[self.at]
        self.bucket = ((other >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def _send(width: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        chunk, rank = table["chunk"][0].as_py(), table["rank"][0].as_py()
        w = Windows(table["text"].to_pylist(), width, buckets)
        order = np.argsort(w.hash)
        h, b = w.hash[order], w.bucket[order]
        order = np.argsort(b, kind="stable")
        h, b = h[order], b[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (b[1:] != b[:-1])
        h, b = h[new], b[new]
        to, at = np.unique(b, return_index=True)
        packed = [pack(x) for x in np.split(h, at[1:])] if len(h) else []
        n = len(packed)
        return pa.table(
            {
                "chunk": pa.array([chunk] * n, pa.int32()),
                "rank": pa.array([rank] * n, pa.int32()),
                "bucket": pa.array(to, pa.int32()),
                "hashes": pa.array(packed, pa.binary()),
            }
        )

    return send


def _answer(table: pa.Table) -> pa.Table:
    """Of one bucket: for each chunk the hashes that a chunk of smaller ids also sent."""
    table = table.sort_by([("rank", "ascending"), ("chunk", "ascending")])
    sent = [unpack(x) for x in table["hashes"].to_pylist()]
    rank = table["rank"].to_numpy()
    h = np.concatenate(sent)
    row = np.repeat(np.arange(len(sent)), [len(x) for x in sent])
    order = np.argsort(h, kind="stable")
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    first = row[new][np.cumsum(new) - 1]
    late = rank[row] > rank[first]
    h, row = h[late], row[late]
    order = np.argsort(row, kind="stable")
    h, row = h[order], row[order]
    to, at = np.unique(row, return_index=True)
    n = len(to)
    return pa.table(
        {
            "chunk": pa.array(table["chunk"].to_numpy()[to], pa.int32()),
            "rank": pa.array(rank[to], pa.int32()),
            "bucket": pa.array([table["bucket"][0].as_py()] * n, pa.int32()),
            "hashes": pa.array([pack(x) for x in np.split(h, at[1:])] if n else [], pa.binary()),
        }
    )


def _joint(h: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return h ^ (bucket.astype(np.uint64) * np.uint64(BASE_B))


def _mark(width: int, buckets: int):
    def mark(docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = docs.sort_by([("doc_id", "ascending")])
        ids = docs["doc_id"].to_pylist()
        w = Windows(docs["text"].to_pylist(), width, buckets)
        # Documents with one id share a rank, so none of them is earlier than another.
        new_id = np.array([i == 0 or ids[i] != ids[i - 1] for i in range(len(ids))], bool)
        rank = np.cumsum(new_id)[w.doc]
        key = _joint(w.hash, w.bucket)
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        late = np.zeros(len(key), bool)
        late[order] = rank[order] > rank[order][new][np.cumsum(new) - 1]
        sent = [
            _joint(unpack(h), np.array([b]))
            for h, b in zip(answers["hashes"].to_pylist(), answers["bucket"].to_pylist())
        ]
        if sent:
            late |= np.isin(key, np.concatenate(sent))
        cover = np.zeros(int(w.ends[-1] if len(ids) else 0) + 1, np.int32)
        np.add.at(cover, w.at[late], 1)
        np.add.at(cover, w.at[late] + width, -1)
        gone = np.cumsum(cover)[:-1] > 0
        texts, removed, spans = [], [], []
        for words, a, b in zip(w.words, w.starts, w.ends):
            off = gone[a:b]
            n = int(off.sum())
            removed.append(n)
            if n:
                words = compress(words, ~off)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], off.view(np.int8), [0]))))
                spans.append([{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)])
            else:
                spans.append([])
            texts.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc_id": docs["doc_id"].cast(pa.int64()),
                "n_words": pa.array(w.ends - w.starts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "removed": pa.array(spans, kind),
                "text": pa.array(texts, pa.string()),
            }
        )

    return mark


def remove_repeats(
    docs: DataFrame,
    width: int = 50,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Documents without the words of windows that a document of a smaller id also holds.

    Returns per row: doc_id, n_words, n_removed, ``removed`` (maximal intervals of word positions,
    end exclusive) and ``text`` (the kept words joined by one space).
    """
    size = text_bytes(docs)
    buckets = parts(size, bucket_bytes)
    chunk, nameless = by_range(docs, parts(size, chunk_bytes))
    dealt = docs.select(F.col("doc_id").cast("bigint"), "text").select(
        chunk.alias("chunk"), "doc_id", "text"
    )
    # Chunks of rows without an id have one rank, after all others.
    dealt = dealt.withColumn("rank", F.least("chunk", F.lit(nameless)))
    sent = dealt.groupBy("chunk").applyInArrow(_send(width, buckets), SENT)
    answers = sent.groupBy("bucket").applyInArrow(_answer, SENT)
    return (
        dealt.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(_mark(width, buckets), KEPT)
    )
