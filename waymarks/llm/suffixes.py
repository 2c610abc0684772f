"""Suffix arrays by induced sorting, and permuted common prefixes, over numpy arrays.

A suffix is smaller (S) or larger (L) than the next one.  The leftmost S suffixes are sorted first: their
substrings by inducing, then, where substrings repeat, their names recursively.  From their order all other
suffixes are induced in one pass up (L) and one pass down (S).  A pass goes bucket by bucket; what a
bucket induces is dealt to its buckets at once, and a bucket that feeds itself is read in waves.
"""

from __future__ import annotations

import numpy as np

from waymarks.llm.terms import ranges

#: Alphabets above this size have too small buckets for a pass; their suffixes are sorted by doubling.
ALPHABET = 2048


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """Order of all suffixes.  ``text`` holds numbers below ``size`` and ends in its only 0."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    small = _types(text)
    left = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    passes = _Passes(text, small, size)
    if len(left) > 1:
        left = _sorted(text, left, passes)
    return passes.induce(left)


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last one is."""
    n = len(text)
    up = text[:-1] < text[1:]
    settled = np.append(text[:-1] != text[1:], True)
    at = np.where(settled, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(up, True)[at]


def _sorted(text: np.ndarray, left: np.ndarray, passes: _Passes) -> np.ndarray:
    """Leftmost smaller suffixes in order, from any order of theirs."""
    order = passes.induce(left)
    is_left = np.zeros(len(text), bool)
    is_left[left] = True
    order = order[is_left[order]]
    # Names: equal substrings, from one leftmost smaller suffix to the next, have one name.
    place = np.empty(len(text), np.int64)
    place[left] = np.arange(len(left))
    length = np.append(np.diff(left), 1)[place[order]]
    same = _equal(text, order[:-1], order[1:], length[:-1], length[1:])
    name = np.cumsum(np.append(True, ~same)) - 1
    if name[-1] == len(left) - 1:
        return order
    reduced = np.empty(len(left), np.int64)
    reduced[place[order]] = name
    count = int(name[-1]) + 1
    by = suffix_array(reduced, count) if count <= ALPHABET else _doubled(reduced)
    return left[by]


def _equal(text, a, b, length_a, length_b) -> np.ndarray:
    """Whether substrings of these starts agree, their last byte included."""
    same = length_a == length_b
    at, k = np.flatnonzero(same), 0
    while len(at):
        differs = text[a[at] + k] != text[b[at] + k]
        same[at[differs]] = False
        k += 1
        at = at[~differs & (length_a[at] >= k)]
    return same


def _doubled(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names, by names of pairs of names, doubling."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    rank = np.empty(n, np.int64)
    key = names[order]
    head = np.append(True, key[1:] != key[:-1])
    # The rank of a group is the place of its first member.
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    step = 1
    while True:
        edge = np.append(np.flatnonzero(head), n)
        many = np.flatnonzero(np.diff(edge) > 1)
        if not len(many):
            return order
        at = ranges(edge[many], edge[many + 1] - edge[many])
        own = order[at]
        after = np.where(own + step < n, rank[np.minimum(own + step, n - 1)], -1)
        group = rank[own]
        by = np.lexsort((after, group))
        own, after, group = own[by], after[by], group[by]
        order[at] = own
        new = np.append(True, (after[1:] != after[:-1]) | (group[1:] != group[:-1]))
        head[at] = new
        rank[own] = np.maximum.accumulate(np.where(new, at, 0))
        step *= 2


class _Passes:
    def __init__(self, text: np.ndarray, small: np.ndarray, size: int):
        self.text, self.small, self.size = text, small, size
        self.first = np.zeros(size + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=size), out=self.first[1:])
        self.kind = np.uint16 if size <= 1 << 16 else np.int64

    def _deal(self, found: np.ndarray, smaller: bool) -> tuple[np.ndarray, np.ndarray]:
        """What suffixes induce: those before them, of one type, with their bucket."""
        before = found[found > 0] - 1
        before = before[self.small[before] == smaller]
        return before, self.text[before]

    def induce(self, left: np.ndarray) -> np.ndarray:
        """All suffixes from the leftmost smaller ones in the given order, up and then down."""
        n, text, first = len(self.text), self.text, self.first
        out = np.empty(n, np.int64)
        # Leftmost smaller suffixes by bucket, in the given order.
        bucket = text[left]
        by = np.argsort(bucket.astype(self.kind), kind="stable")
        seeds, cut = left[by], np.searchsorted(bucket[by], np.arange(self.size + 1))
        head = first[:-1].copy()
        for c in np.flatnonzero(np.diff(first)).tolist():
            done = first[c]
            while done < head[c]:
                wave = out[done : head[c]]
                done = head[c]
                self._put(out, head, *self._deal(wave, False), up=True)
            if cut[c] < cut[c + 1]:
                self._put(out, head, *self._deal(seeds[cut[c] : cut[c + 1]], False), up=True)
        tail = first[1:].copy()
        large_end = head
        # The end of the text is the smallest suffix; the pass down starts from the larger ones.
        out[0] = n - 1
        for c in np.flatnonzero(np.diff(first))[::-1].tolist():
            if c == 0:
                continue
            done = first[c + 1]
            while tail[c] < done:
                wave = out[tail[c] : done][::-1]
                done = tail[c]
                self._put(out, tail, *self._deal(wave, True), up=False)
            if first[c] < large_end[c]:
                wave = out[first[c] : large_end[c]][::-1]
                self._put(out, tail, *self._deal(wave, True), up=False)
        return out

    def _put(self, out, edge, found: np.ndarray, bucket: np.ndarray, up: bool) -> None:
        """Deal ``found`` to the heads (or, from behind, the tails) of their buckets, in order."""
        if not len(found):
            return
        if len(found) < 8:
            for f, b in zip(found.tolist(), bucket.tolist()):
                if up:
                    out[edge[b]] = f
                    edge[b] += 1
                else:
                    edge[b] -= 1
                    out[edge[b]] = f
            return
        by = np.argsort(bucket.astype(self.kind, copy=False), kind="stable")
        found, bucket = found[by], bucket[by]
        at = np.flatnonzero(np.diff(bucket, prepend=-1))
        count = np.diff(np.append(at, len(bucket)))
        to = bucket[at]
        rank = np.arange(len(found)) - np.repeat(at, count)
        if up:
            out[np.repeat(edge[to], count) + rank] = found
            edge[to] += count
        else:
            out[np.repeat(edge[to], count) - 1 - rank] = found
            edge[to] -= count


def permuted_prefixes(text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the one before it in order (-1 for the first) and their common prefix.

    A common prefix is one less than that of the suffix on its left where the bytes on the left
    agree; only the others are compared.
    """
    n = len(text)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    at = np.arange(n)
    follows = (at > 0) & (before > 0)
    follows[follows] = text[at[follows] - 1] == text[before[follows] - 1]
    own = np.flatnonzero(~follows & (before >= 0))
    common = np.zeros(n, np.int64)
    common[own] = _common(text, own, before[own])
    head = np.maximum.accumulate(np.where(~follows, at, 0))
    return before, common[head] - (at - head)


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each two suffixes.  No two end together: the end is unique."""
    out = np.zeros(len(a), np.int64)
    wide = np.concatenate([text.astype(np.uint16), np.zeros(4, np.uint16)])
    words = np.ndarray((len(text) + 1,), "<u8", wide, strides=(2,))
    open_ = np.arange(len(a))
    last = len(text)
    while len(open_):
        x = words[np.minimum(a[open_] + out[open_], last)]
        y = words[np.minimum(b[open_] + out[open_], last)]
        differ = x != y
        bits = x[differ] ^ y[differ]
        lowest = bits & (~bits + np.uint64(1))
        # Two bytes a number: the lowest differing bit says how many numbers agree.
        out[open_[differ]] += (lowest >= 1 << 16).astype(np.int64) + (lowest >= 1 << 32) + (
            lowest >= 1 << 48
        )
        open_ = open_[~differ]
        out[open_] += 4
    return out
