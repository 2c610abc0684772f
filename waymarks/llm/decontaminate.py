"""Benchmark decontamination by spaced seeds.

A seed is a window of tokens of which a fixed mask keeps some positions and ignores the others, so a
substituted word at an ignored position leaves its hash as it is.  The hashes of every window of the
benchmark under every mask are joined with those of the documents.  Around each hit, document and
item are compared token by token along the hit's diagonal, and the longest run with enough equal
tokens is a verified overlap if it is long enough; then its two sides are searched.  Unequal tokens
at its ends are left out unless it would be too short without them.

Tokens are words in lower case without characters other than letters and digits; what has none is
no token.

A hit counts by its diagonal only, and runs of one seed, as a repeated word has them, give a range of
diagonals at once; pairs of equal seeds are never listed.

The benchmark is a query set: it is dealt into blocks of bounded text, each sent to the tasks in turn
and met by all documents, so what is broadcast never exceeds a block, whatever the benchmark's size.

Defined results: NULL or empty texts and items match nothing.  An item shorter than the shortest
overlap matches only as a whole, one shorter than every seed only where all its tokens are equal.
A NULL doc_id is returned as it is;
repeated rows are compared each.  A NULL item_id takes no part.  Empty tables give an empty result.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymarks.llm.chunks import parts
from waymarks.llm.hashing import BASE_A, WordHashes, finish, words_of

#: The masks, 1 for a position that counts.  Weight 6 within 9 to 11 positions.
MASKS = ("111010011", "1101100101", "11010001011", "1011001101")
#: Shortest verified overlap in tokens, and its share of equal tokens in percent.
LEAST_TOKENS = 12
LEAST_PERCENT = 75
#: UTF-8 bytes of benchmark text in one block, about.
BLOCK_BYTES = 8_000_000
#: Bits of the table that says quickly that no seed has a hash.
FILTER_BITS = 24

OVERLAP = (
    "doc_id bigint, item_id bigint, doc_start bigint, doc_end bigint, item_start bigint, "
    "item_end bigint, matches bigint, word_start bigint, word_end bigint"
)


class TokenHashes(WordHashes):
    """Hash of a word's letters and digits in lower case; 0 if it has none."""

    def hash(self, word: bytes) -> int:
        text = word.decode("utf-8", "surrogatepass").lower()
        if not text.isalnum():
            text = "".join(c for c in text if c.isalnum())
        return super().hash(text.encode("utf-8", "surrogatepass")) or 1 if text else 0


def tokens_of(text: str | None, hashes: TokenHashes) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a text and the word each comes from."""
    h = hashes.array(words_of(text))
    at = np.flatnonzero(h)
    return h[at], at


def seeds(tokens: np.ndarray, mask: str) -> np.ndarray:
    """Hashes of the kept positions of every window."""
    n = len(tokens) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, len(mask), np.uint64)
    for i, keep in enumerate(mask):
        if keep == "1":
            h = h * np.uint64(BASE_A) + tokens[i : i + n]
    return finish(h)


class Block:
    """Seeds of a block of benchmark items, sorted by hash.

    Equal seeds at consecutive positions of an item, as a repeated word has them, are one run.
    """

    def __init__(self, items: list[tuple[int, str | None]], masks: tuple[str, ...]):
        hashes = TokenHashes()
        self.ids = [i for i, _ in items]
        self.tokens = [tokens_of(t, hashes)[0] for _, t in items]
        self.longest = max(map(len, self.tokens), default=0)
        self.seeds = []
        # Items shorter than every mask are looked up whole.
        short = {len(t) for t in self.tokens if 0 < len(t) < min(map(len, masks))}
        whole = tuple("1" * n for n in sorted(short))
        self.masks = masks + whole
        for mask in self.masks:
            per = [
                seeds(t, mask) if mask not in whole or len(t) == len(mask) else seeds(t[:0], mask)
                for t in self.tokens
            ]
            h = np.concatenate(per) if per else np.empty(0, np.uint64)
            item = np.repeat(np.arange(len(per)), [len(x) for x in per])
            at = np.concatenate([np.arange(len(x)) for x in per]) if per else item
            order = np.argsort(h, kind="stable")
            h, item, at = h[order], item[order], at[order]
            first, last = runs(h, at, item)
            h, item, first, last = h[first], item[first], at[first], at[last]
            likely = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
            top = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            np.bitwise_or.at(likely, top >> 3, (1 << (top & 7)).astype(np.uint8))
            self.seeds.append((h, item, first, last, likely))

    def diagonals(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, low, high): the diagonals, text position less item position, on which text
        and item share a seed, as ranges without common diagonals, high exclusive; by text.

        Pairs of runs are made in bounded numbers and merged, so that memory follows the number of
        diagonals, which is at most the length of text and item together.
        """
        # Joined texts are looked up at once; zeros keep seeds from matching across texts.
        gap = np.zeros(max(map(len, self.masks)), np.uint64)
        joined = np.concatenate([x for t in texts for x in (t, gap)])
        sizes = np.array([len(t) + len(gap) for t in texts])
        ends = np.cumsum(sizes)
        # A diagonal as one number: texts lie apart by the longest item, items by all texts.
        apart = self.longest + 1
        span = len(joined) + (len(texts) + 1) * apart
        kept = [np.empty((2, 0), np.int64)]
        held = 0
        for mask, (h, item, first, last, likely) in zip(self.masks, self.seeds):
            own = seeds(joined, mask)
            top = (own >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            where = np.flatnonzero(likely[top >> 3] >> (top & 7).astype(np.uint8) & 1)
            start, stop = runs(own[where], where)
            start, stop = where[start], where[stop]
            low = np.searchsorted(h, own[start], side="left")
            n = np.searchsorted(h, own[start], side="right") - low
            start, stop, low, n = (x[n > 0] for x in (start, stop, low, n))
            text = np.searchsorted(ends, start, side="right")
            total = np.concatenate(([0], np.cumsum(n)))
            for begin in range(0, int(total[-1]), PAIRS):
                pair = np.arange(begin, min(begin + PAIRS, int(total[-1])))
                run = np.searchsorted(total, pair, side="right") - 1
                of = low[run] + pair - total[run]
                base = item[of] * span + (text[run] + 1) * apart
                found = np.stack((base + start[run] - last[of], base + stop[run] - first[of] + 1))
                kept.append(merged(found))
                held += kept[-1].shape[1]
                if held > PAIRS:
                    kept = [merged(np.concatenate(kept, axis=1))]
                    held = kept[0].shape[1] // 2  # merge again after as many new ones
        ranges = merged(np.concatenate(kept, axis=1))
        item, where = ranges[0] // span, ranges[0] % span
        # Texts take up their length and the distance to the next.
        begins = ends - sizes + np.arange(1, len(texts) + 1) * apart
        text = np.searchsorted(begins - self.longest, where, side="right") - 1
        low = where - begins[text]
        high = low + ranges[1] - ranges[0]
        order = np.argsort(text, kind="stable")
        for i in order.tolist():
            yield int(text[i]), int(item[i]), int(low[i]), int(high[i])


#: Pairs of runs compared at once.
PAIRS = 1 << 20


def runs(h: np.ndarray, at: np.ndarray, item: np.ndarray | None = None):
    """Index of the first and the last of each run of equal hashes at consecutive positions."""
    if not len(h):
        none = np.empty(0, np.int64)
        return none, none
    new = (h[1:] != h[:-1]) | (at[1:] != at[:-1] + 1)
    if item is not None:
        new |= item[1:] != item[:-1]
    cut = np.flatnonzero(new)
    return np.concatenate(([0], cut + 1)), np.concatenate((cut, [len(h) - 1]))


def merged(ranges: np.ndarray) -> np.ndarray:
    """Ranges (low, high exclusive) with those that overlap made one, sorted."""
    if not ranges.shape[1]:
        return ranges
    low, high = ranges[:, np.argsort(ranges[0], kind="stable")]
    reach = np.maximum.accumulate(high)
    cut = np.flatnonzero(low[1:] >= reach[:-1])
    return np.stack((low[np.concatenate(([0], cut + 1))], reach[np.concatenate((cut, [len(low) - 1]))]))


def longest_run(equal: np.ndarray, percent: int) -> tuple[int, int]:
    """The longest run with ``percent`` equal tokens or more, the first of several."""
    sums = np.concatenate(([0], np.cumsum(np.where(equal, 100 - percent, -percent))))
    # The run to an end begins where the sum is first as low as there.
    start = np.searchsorted(-np.minimum.accumulate(sums), -sums, side="left")
    end = int(np.argmax(np.arange(len(sums)) - start))
    return int(start[end]), end


def trimmed(equal: np.ndarray, s: int, e: int, least: int) -> tuple[int, int]:
    """A run without unequal tokens at its ends, but for what ``least`` tokens need."""
    while e - s > least and not equal[e - 1]:
        e -= 1
    while e - s > least and not equal[s]:
        s += 1
    return s, e


def _on_diagonal(tokens, own, shift: int, least: int, percent: int):
    """(text start, text end, item start, item end, equal tokens) of every overlap on a diagonal."""
    first, last = max(0, -shift), min(len(own), len(tokens) - shift)
    need = min(least, len(own))
    if last - first < need:
        return
    equal = own[first:last] == tokens[first + shift : last + shift]
    if equal.all():  # the whole diagonal is one run
        yield first + shift, last + shift, first, last, last - first
        return
    todo = [(0, len(equal))]
    while todo:  # every long run on the diagonal, longest first
        a, b = todo.pop()
        if b - a < need:
            continue
        s, e = longest_run(equal[a:b], percent)
        if e - s >= need:
            s, e = trimmed(equal, s + a, e + a, need)
            n = int(equal[s:e].sum())
            yield s + first + shift, e + first + shift, s + first, e + first, n
            todo += [(a, s), (e, b)]


def _found(block: Block, texts: list[str | None], hashes: TokenHashes, least: int, percent: int):
    """(row, item_id, doc span, item span, matches, word span) of every overlap of some texts, in
    order of rows."""
    taken = [tokens_of(t, hashes) for t in texts]
    for k, i, low, high in block.diagonals([t for t, _ in taken]):
        tokens, words = taken[k]
        for shift in range(low, high):
            for s, e, a, b, n in _on_diagonal(tokens, block.tokens[i], shift, least, percent):
                yield k, block.ids[i], s, e, a, b, n, int(words[s]), int(words[e - 1]) + 1


def _texts_with_overlaps(block, texts, hashes, least: int, percent: int) -> Iterator[int]:
    """Rows that have an overlap; the first one found settles it."""
    taken = [tokens_of(t, hashes)[0] for t in texts]
    for k, ranges in groupby(block.diagonals(taken), key=itemgetter(0)):
        overlaps = (
            overlap
            for _, i, low, high in ranges
            for shift in range(low, high)
            for overlap in _on_diagonal(taken[k], block.tokens[i], shift, least, percent)
        )
        if next(overlaps, None):
            yield k


#: Texts looked up at once, and overlaps in one batch.
TEXTS = 500
ROWS = 10_000


def _compare(shared, least: int, percent: int):
    names = [c.split()[0] for c in OVERLAP.split(", ")]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = TokenHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                ids, texts = part["doc_id"].to_pylist(), part["text"].to_pylist()
                found = _found(shared.value, texts, hashes, least, percent)
                rows = ((ids[k], *x) for k, *x in found)
                while some := list(islice(rows, ROWS)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*some)], names
                    )

    return compare


def _blocks(benchmark: DataFrame, masks: tuple[str, ...], block_bytes: int):
    """Broadcast blocks of the benchmark, one after the other."""
    items = benchmark.select(F.col("item_id").cast("bigint"), "text").where("item_id IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = parts(size, block_bytes)
    number = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    for i in range(blocks):
        rows = items.where(number == i).collect()  # a block of bounded text
        block = Block([(r.item_id, r.text) for r in rows], masks)
        yield items.sparkSession.sparkContext.broadcast(block)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[str, ...] = MASKS,
    least: int = LEAST_TOKENS,
    percent: int = LEAST_PERCENT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Verified overlaps of documents (doc_id, text) with benchmark items (item_id, text).

    Returns doc_id, item_id, the overlap's tokens in the document (doc_start, doc_end) and in the
    item, the number of equal tokens, and the overlap's words (word_start, word_end); ends exclusive.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    out = None
    for shared in _blocks(benchmark, masks, block_bytes):
        found = docs.mapInArrow(_compare(shared, least, percent), OVERLAP)
        out = found if out is None else out.union(found)
    return out


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[str, ...] = MASKS,
    least: int = LEAST_TOKENS,
    percent: int = LEAST_PERCENT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that have no verified overlap."""
    column = docs.columns.index("text")
    for shared in _blocks(benchmark, masks, block_bytes):

        def run(batches, shared=shared):
            hashes = TokenHashes()
            for batch in batches:
                for at in range(0, batch.num_rows, TEXTS):
                    part = batch.slice(at, TEXTS)
                    texts = part.column(column).to_pylist()
                    keep = np.ones(len(texts), bool)
                    for k in _texts_with_overlaps(shared.value, texts, hashes, least, percent):
                        keep[k] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def contaminated(found: DataFrame) -> DataFrame:
    """One row for each document with overlaps: its items, and all words that overlaps cover."""
    spans = F.array_sort(F.collect_set(F.struct("word_start", "word_end")))
    return found.groupBy("doc_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"),
        F.max("matches").alias("most_matches"),
        spans.alias("spans"),
    )
