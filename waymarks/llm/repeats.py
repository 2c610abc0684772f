"""Exact removal of repeated byte strings, by suffix arrays of content-defined shards.

Any two equal strings of ``width`` bytes hold the same smallest gram (the leftmost one whose hash is
smallest) at the same place.  Starts of windows in a row that share one such gram make a *piece*; every
window lies in one piece, and equal windows in pieces of one gram.  So grams are the keys by which Spark
brings together what can be equal:

1. Chunks of documents send the hashes of their distinct pieces to the bucket of their gram.
2. A bucket asks for the texts of pieces whose gram has several different pieces, each from one chunk.
   Grams that occur once have no repeated window, and equal pieces are one piece with a count.
3. Chunks send the texts asked for.
4. A bucket cuts its pieces into shards, gram by gram, makes the suffix array of each by induced sorting
   and its permuted common prefixes: windows repeat where the common prefix reaches ``width``.
   Each chunk that holds such a piece is told.
5. Chunks remove the bytes of all repeated windows.

A gram with more than ``SPLIT`` different pieces (a line that very many documents share, each time between
other words) would make one large shard.  Its windows are dealt by their own hashes instead and
counted, each distinct one once a chunk.

Defined results: NULL text is empty.  Texts shorter than ``width`` stay whole.  Repeated rows are
documents of their own, so they remove each other.  A NULL doc_id is a value like any other.  What is
kept are bytes, as a cut may split a character.  An empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymarks.llm.chunks import CHUNK_BYTES, parts, text_bytes
from waymarks.llm.hashing import BASE_A, BASE_B, _powers, finish
from waymarks.llm.suffixes import permuted_prefixes, suffix_array
from waymarks.llm.terms import ranges, text_buffers

#: Bytes of a window, and of the grams that key it.
WIDTH = 200
GRAM = 48
#: Different pieces of one gram that are compared in one shard.
SPLIT = 4000
#: Bytes of one suffix array, about.
SHARD_BYTES = 1_500_000
#: Text bytes whose pieces one bucket receives, about.
BUCKET_BYTES = 12_000_000

#: Random 64-bit value of each byte.
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, np.uint64)
_LOW = np.uint64(0xFFFFFFFF)

SENT = "chunk int, bucket int, gram binary, content binary, many binary"
ASKED = "chunk int, bucket int, keys binary, windows binary"
TEXTS = "chunk int, bucket int, keys binary, sizes binary, texts binary, windows binary, many binary"
TOLD = "chunk int, keys binary, n_spans binary, spans binary, windows binary"
KEPT = (
    "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
    "removed array<struct<start:bigint,end:bigint>>, kept binary"
)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


_SENT, _ASKED, _TEXTS, _TOLD = map(_schema, (SENT, ASKED, TEXTS, TOLD))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _joined(column: pa.ChunkedArray, kind=np.uint64) -> np.ndarray:
    values = [np.frombuffer(x, kind) for x in column.to_pylist() if x is not None]
    return np.concatenate(values) if values else np.empty(0, kind)


def _sizes(column: pa.ChunkedArray, width: int = 8) -> np.ndarray:
    return np.array([0 if x is None else len(x) // width for x in column.to_pylist()], np.int64)


def _groups(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Distinct values and the places of each."""
    by = np.argsort(values, kind="stable")
    found, cut = np.unique(values[by], return_index=True)
    yield from zip(found.tolist(), np.split(by, cut[1:]))


class Pieces:
    """The pieces of a chunk of documents: runs of window starts with one smallest gram."""

    def __init__(self, texts: pa.ChunkedArray, width: int):
        self.offsets, self.data = text_buffers(texts)
        self.width = width
        n = len(self.data)
        inverse = pow(BASE_A, -1, 1 << 64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * _powers(inverse, n), out=self.sums[1:])
        self.power = _powers(BASE_A, n)
        size = np.diff(self.offsets)
        windows = np.maximum(size - width + 1, 0)
        self.at = ranges(self.offsets[:-1], windows)
        if not len(self.at):
            none = np.empty(0, np.uint64)
            self.first = self.starts = np.empty(0, np.int64)
            self.gram = self.content = self.key = none
            return
        gram = min(GRAM, width)
        hashes = self._hash(np.arange(n - gram + 1), gram)
        low = hashes & ~_LOW | np.arange(len(hashes), dtype=np.uint64)
        span, have = width - gram + 1, 1
        while 2 * have <= span:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        if have < span:
            low = np.minimum(low[: len(low) - (span - have)], low[span - have :])
        smallest = (low[self.at] & _LOW).astype(np.int64)
        begins = np.ones(len(self.at), bool)
        begins[1:] = (smallest[1:] != smallest[:-1]) | (np.diff(self.at) != 1)
        head = np.flatnonzero(begins)
        self.first = self.at[head]
        self.starts = np.diff(np.append(head, len(self.at)))
        self.gram = hashes[smallest[head]]
        self.content = self._hash(self.first, self.starts + width - 1)
        self.key = keys_of(self.gram, self.content)

    def _hash(self, first: np.ndarray, size) -> np.ndarray:
        part = (self.sums[first + size] - self.sums[first]) * self.power[first]
        return finish(part + np.asarray(size, np.uint64) * np.uint64(BASE_B))

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """One place of each different piece, and whether the chunk has several."""
        _, at, count = np.unique(self.key, return_index=True, return_counts=True)
        return at, count > 1

    def windows(self, first: np.ndarray) -> np.ndarray:
        return self._hash(first, self.width)


def keys_of(gram: np.ndarray, content: np.ndarray) -> np.ndarray:
    return finish(content + gram * np.uint64(BASE_B))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)


def _send(width: int, buckets: int):
    def send(docs: pa.Table) -> pa.Table:
        chunk = docs["chunk"][0].as_py()
        p = Pieces(docs["text"], width)
        at, many = p.distinct()
        gram, content = p.gram[at], p.content[at]
        rows = [
            (chunk, b, gram[i].tobytes(), content[i].tobytes(), many[i].tobytes())
            for b, i in _groups(_bucket(gram, buckets))
        ]
        return _table(rows, _SENT)

    return send


class Sent:
    """What chunks sent to one bucket: entries sorted by gram and content, chunks of one mixed."""

    def __init__(self, sent: pa.Table):
        gram, content = _joined(sent["gram"]), _joined(sent["content"])
        many = _joined(sent["many"], bool)
        chunk = np.repeat(sent["chunk"].to_numpy().astype(np.int64), _sizes(sent["gram"]))
        mixed = finish(content ^ chunk.astype(np.uint64))
        by = np.lexsort((chunk, mixed, content, gram))
        gram, content, self.chunk = gram[by], content[by], chunk[by]
        new_gram = np.append(True, gram[1:] != gram[:-1])[: len(gram)]
        new = new_gram.copy()
        new[1:] |= content[1:] != content[:-1]
        self.first = np.flatnonzero(new)
        self.piece = np.cumsum(new) - 1
        self.key = keys_of(gram, content)[self.first]
        count = 1 + many[by].astype(np.int64)
        self.count = np.add.reduceat(count, self.first) if len(count) else count
        self.gram = (np.cumsum(new_gram) - 1)[self.first]
        self.different = np.bincount(self.gram)[self.gram]


def _ask(split: int):
    def ask(sent: pa.Table) -> pa.Table:
        """Which chunk sends a piece's text, and which send the windows of pieces of a common gram."""
        bucket = sent["bucket"][0].as_py()
        s = Sent(sent)
        common = s.different > split
        wanted = np.flatnonzero((s.different > 1) & ~common)
        from_ = s.chunk[s.first[wanted]]
        asked = {c: s.key[wanted[i]].tobytes() for c, i in _groups(from_)}
        held = np.flatnonzero(common[s.piece])
        windows = {c: s.key[s.piece[held[i]]].tobytes() for c, i in _groups(s.chunk[held])}
        rows = [(c, bucket, asked.get(c), windows.get(c)) for c in sorted({*asked, *windows})]
        return _table(rows, _ASKED)

    return ask


def _text(width: int, buckets: int):
    def text(docs: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(asked) or not len(docs):
            return _TEXTS.empty_table()
        chunk = docs["chunk"][0].as_py()
        p = Pieces(docs["text"], width)
        at, many = p.distinct()
        order = np.argsort(p.key[at])
        at, many = at[order], many[order]
        key = p.key[at]
        rows = []
        for bucket, keys in zip(asked["bucket"].to_pylist(), asked["keys"].to_pylist()):
            if keys is None:
                continue
            keys = np.frombuffer(keys, np.uint64)
            own = at[np.searchsorted(key, keys)]
            size = p.starts[own] + width - 1
            texts = p.data[ranges(p.first[own], size)].tobytes()
            none = (None, None)
            rows.append((chunk, bucket, keys.tobytes(), size.astype(np.uint32).tobytes(), texts, *none))
        keys = _joined(asked["windows"])
        if len(keys):
            found = np.searchsorted(key, keys)
            own = at[found]
            hashes = p.windows(ranges(p.first[own], p.starts[own]))
            twice = np.repeat(many[found], p.starts[own])
            hashes, place, count = np.unique(hashes, return_inverse=True, return_counts=True)
            several = count > 1
            np.logical_or.at(several, place, twice)
            rows += [
                (chunk, b, None, None, None, hashes[i].tobytes(), several[i].tobytes())
                for b, i in _groups(_bucket(hashes, buckets))
            ]
        return _table(rows, _TEXTS)

    return text


def _repeated(texts: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """Of pieces in one shard, one flag a window: whether its bytes also start elsewhere."""
    first = np.cumsum(size + 1) - (size + 1)
    string = np.ones(int((size + 1).sum()) + 1, np.uint16)
    string[ranges(first, size)] = texts.astype(np.uint16) + 2
    string[-1] = 0
    before, common = permuted_prefixes(string, suffix_array(string, 258))
    hit = common >= width
    out = hit.copy()
    out[before[hit]] = True
    return out[ranges(first, size - width + 1)]


def _tell(width: int, shard_bytes: int):
    def spans(s: Sent, texts: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Of each piece how many spans of window starts repeat (-1: all), and the spans."""
        n_spans = np.where(s.count > 1, -1, 0)
        key, size = _joined(texts["keys"]), _joined(texts["sizes"], np.uint32).astype(np.int64)
        if not len(key):
            return n_spans, np.empty((0, 2), np.uint32)
        data = _joined(texts["texts"], np.uint8)
        by_key = np.argsort(s.key)
        piece = by_key[np.searchsorted(s.key, key, sorter=by_key)]
        order = np.argsort(piece)  # by gram
        piece, size, first = piece[order], size[order], (np.cumsum(size) - size)[order]
        # Shards end between grams.
        gram = s.gram[piece]
        new = np.flatnonzero(np.diff(gram, prepend=-1))
        ends = np.append(np.cumsum(size)[new[1:] - 1], int(size.sum()))
        shard = np.repeat(ends // shard_bytes, np.diff(np.append(new, len(gram))))
        edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(gram)]
        flags = [
            _repeated(data[ranges(first[a:b], size[a:b])], size[a:b], width)
            for a, b in zip(edges[:-1], edges[1:])
        ]
        flag = np.concatenate(flags)
        starts = size - width + 1
        own = np.repeat(piece, starts)
        place = ranges(np.zeros(len(starts), np.int64), starts)
        flag &= s.count[own] == 1
        same = own[1:] == own[:-1]
        begins, stops = flag.copy(), flag.copy()
        begins[1:] &= ~(flag[:-1] & same)
        stops[:-1] &= ~(flag[1:] & same)
        n_spans += np.bincount(own[begins], minlength=len(n_spans))
        found = np.stack([place[begins], place[stops] + 1], 1).astype(np.uint32)
        return n_spans, found

    def tell(sent: pa.Table, texts: pa.Table) -> pa.Table:
        rows = []
        if len(sent):
            s = Sent(sent)
            n_spans, found = spans(s, texts)
            size = np.maximum(n_spans, 0)
            first = np.cumsum(size) - size
            held = np.flatnonzero(n_spans[s.piece] != 0)
            for chunk, i in _groups(s.chunk[held]):
                own = s.piece[held[i]]
                rows.append(
                    (
                        chunk,
                        s.key[own].tobytes(),
                        n_spans[own].astype(np.int32).tobytes(),
                        found[ranges(first[own], size[own])].tobytes(),
                        None,
                    )
                )
        hashes = _joined(texts["windows"])
        if len(hashes):
            count = 1 + _joined(texts["many"], bool).astype(np.int64)
            chunk = np.repeat(texts["chunk"].to_numpy(), _sizes(texts["windows"]))
            _, place = np.unique(hashes, return_inverse=True)
            held = np.flatnonzero(np.bincount(place, count)[place] > 1)
            rows += [
                (c, None, None, None, hashes[held[i]].tobytes()) for c, i in _groups(chunk[held])
            ]
        return _table(rows, _TOLD)

    return tell


def _mark(width: int):
    def mark(docs: pa.Table, told: pa.Table) -> pa.Table:
        p = Pieces(docs["text"], width)
        n = len(p.data)
        cover = np.zeros(n + 1, np.int32)

        def covered(first: np.ndarray, last: np.ndarray) -> None:
            np.add.at(cover, first, 1)
            np.add.at(cover, last + width, -1)

        key = _joined(told["keys"])
        if len(key):
            size = _joined(told["n_spans"], np.int32).astype(np.int64)
            found = _joined(told["spans"], np.uint32).reshape(-1, 2).astype(np.int64)
            first = np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0)
            by = np.argsort(key)
            at = by[np.minimum(np.searchsorted(key, p.key, sorter=by), len(key) - 1)]
            hit = key[at] == p.key
            whole = hit & (size[at] < 0)
            covered(p.first[whole], p.first[whole] + p.starts[whole] - 1)
            partly = np.flatnonzero(hit & (size[at] > 0))
            count = size[at[partly]]
            span = found[ranges(first[at[partly]], count)]
            base = np.repeat(p.first[partly], count)
            covered(base + span[:, 0], base + span[:, 1] - 1)
        hashes = _joined(told["windows"])
        if len(hashes):
            again = p.at[np.isin(p.windows(p.at), hashes)]
            covered(again, again)
        gone = np.cumsum(cover)[:-1] > 0
        edge = np.zeros(n + 1, bool)
        edge[p.offsets] = True
        begins, stops = gone.copy(), gone.copy()
        begins[1:] &= ~gone[:-1] | edge[1:-1]
        stops[:-1] &= ~gone[1:] | edge[1:-1]
        begins, stops = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        span_edges = np.searchsorted(begins, p.offsets)
        base = np.repeat(p.offsets[:-1], np.diff(span_edges))
        removed = pa.ListArray.from_arrays(
            pa.array(span_edges, pa.int32()),
            pa.StructArray.from_arrays([pa.array(begins - base), pa.array(stops - base)], ["start", "end"]),
        )
        kept_before = np.append(0, np.cumsum(~gone))[p.offsets]
        kept = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(docs),
            [None, pa.py_buffer(kept_before.tobytes()), pa.py_buffer(p.data[~gone].tobytes())],
        )
        size = np.diff(p.offsets)
        return pa.table(
            {
                "doc_id": docs["doc_id"].cast(pa.int64()),
                "n_bytes": pa.array(size),
                "n_removed": pa.array(size - np.diff(kept_before)),
                "n_spans": pa.array(np.diff(span_edges)),
                "removed": removed,
                "kept": kept.cast(pa.binary()),
            }
        )

    return mark


def remove_repeated_bytes(
    docs: DataFrame,
    width: int = WIDTH,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    shard_bytes: int = SHARD_BYTES,
    split: int = SPLIT,
) -> DataFrame:
    """Documents without the bytes of strings of ``width`` bytes that also start elsewhere.

    Returns per row: doc_id, n_bytes, n_removed, n_spans, ``removed`` (maximal spans of bytes, end
    exclusive) and ``kept`` (the bytes left).
    """
    size = text_bytes(docs)
    buckets = parts(size, bucket_bytes)
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts(size, chunk_bytes))).cast("int")
    dealt = docs.select(F.col("doc_id").cast("bigint"), "text").withColumn("chunk", chunk)
    dealt = dealt.select("chunk", "doc_id", "text")
    by_chunk = dealt.groupBy("chunk")
    sent = by_chunk.applyInArrow(_send(width, buckets), SENT)
    asked = sent.groupBy("bucket").applyInArrow(_ask(split), ASKED)
    texts = by_chunk.cogroup(asked.groupBy("chunk")).applyInArrow(_text(width, buckets), TEXTS)
    tell = _tell(width, shard_bytes)
    told = sent.groupBy("bucket").cogroup(texts.groupBy("bucket")).applyInArrow(tell, TOLD)
    return by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(_mark(width), KEPT)
