"""Terms of texts as pointers into Arrow text buffers, and their multikey sort.

A term is a maximal run of bytes that a byte table maps to something other than 0; the table also
lower-cases A-Z.  Terms never cross documents.  No term holds the byte 0, so slices padded with zeros
compare like the terms themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes of one shard, about; a longer document is a shard of its own.
SHARD_BYTES = 8_000_000
#: Slices of eight bytes sorted as numbers; what is still equal then is sorted as bytes.
SLICES = 64

_KEPT = np.array([0] + [(1 << 64) - (1 << (64 - 8 * b)) for b in range(1, 9)], np.uint64)


def byte_table(digits: bool) -> np.ndarray:
    """Bytes of terms, lower-cased; 0 for separators.  All bytes above 0x7F belong to terms."""
    table = np.zeros(256, np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    letters = np.arange(ord("a"), ord("z") + 1)
    table[letters] = table[letters - 32] = letters
    if digits:
        table[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
    return table


def shards(batches: Iterator[pa.RecordBatch], most: int = SHARD_BYTES) -> Iterator[pa.Table]:
    """Slices of whole rows with about ``most`` bytes of ``text`` each."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        sizes = np.diff(text_buffers(table["text"])[0])
        cut = np.cumsum(sizes) // most
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), len(sizes)]
        for a, b in zip(edges[:-1], edges[1:]):
            if b > a:
                yield table.slice(a, b - a)


def text_buffers(text: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and bytes of the texts, NULL as empty."""
    column = text.cast(pa.large_string()).combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.fill_null("")
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


class Terms:
    """Pointers to the terms of a column of texts: ``start``, ``length`` and ``doc`` (row)."""

    def __init__(self, text: pa.ChunkedArray, table: np.ndarray):
        offsets, data = text_buffers(text)
        self.data = table[data]
        inside = self.data != 0
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends = inside
        ends[:-1] &= ~(ends[1:] & ~edge[1:-1])
        self.start = np.flatnonzero(begins)
        self.length = np.flatnonzero(ends) + 1 - self.start
        self.counts = np.diff(np.searchsorted(self.start, offsets))
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.counts)


def sort_pointers(
    data: np.ndarray, start: np.ndarray, length: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of the pointers by their terms, and where runs of equal terms begin.

    A multikey sort: pointers are sorted by their first eight bytes, and each run of equal slices
    that holds a longer term by the next eight.
    """
    n = len(start)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), ">u8", padded, strides=(1,))

    def sliced(p: np.ndarray, k: int) -> np.ndarray:
        left = np.clip(length[p] - 8 * k, 0, 8)
        at = np.minimum(start[p] + 8 * k, len(data))
        return words[at].astype(np.uint64) & _KEPT[left]

    key = sliced(np.arange(n), 0)
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    pos, k = np.arange(n), 1
    while len(pos):
        # Runs of more than one pointer with a term that goes on.
        first = np.flatnonzero(new[pos])
        size = np.diff(np.append(first, len(pos)))
        goes_on = np.maximum.reduceat(length[order[pos]], first) > 8 * k
        run = np.repeat(np.arange(len(first)), size)
        open_ = (goes_on & (size > 1))[run]
        pos, run = pos[open_], run[open_]
        if not len(pos):
            break
        if k == SLICES:
            _sort_rest(padded, start, length, order, new, pos, run, 8 * k)
            break
        own = order[pos]
        key = sliced(own, k)
        by = np.lexsort((key, run))
        order[pos] = own[by]
        key = key[by]
        changed = np.ones(len(pos), bool)
        changed[1:] = (key[1:] != key[:-1]) | (run[1:] != run[:-1])
        new[pos] = changed
        k += 1
    return order, new


def _sort_rest(data, start, length, order, new, pos, run, skip) -> None:
    first = np.flatnonzero(np.diff(run, prepend=-1))
    for at in np.split(pos, first[1:]):
        tails = [
            (data[start[p] + skip : start[p] + max(skip, length[p])].tobytes(), p)
            for p in order[at].tolist()
        ]
        tails.sort(key=lambda t: t[0])
        order[at] = [p for _, p in tails]
        new[at[1:]] = [a[0] != b[0] for a, b in zip(tails[:-1], tails[1:])]


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``first[i] ... first[i] + size[i] - 1`` of all i in a row."""
    skipped = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(first - skipped, size)
