"""Class-based n-gram scores: exchange clustering, class transitions, word emissions.

1. Vocabulary.  All words of the training rows are counted exactly in Spark.  Every word with
   ``least`` or more tokens is a unit of its own, so the vocabulary grows with the corpus.  Rarer
   words have too few neighbours to learn from: their unit is their ending if it makes up a share of
   the tokens, else the rest.
2. Seed.  Words and endings that make up a share of the training tokens (at most ``4 / (3 * share)``
   each) are clustered exactly on the driver, one move at a time.
3. Exchange rounds.  Counts of (unit, neighbour) over all training rows are dealt by unit into parts
   and stored; a unit with very many tokens is dealt over all parts by its neighbours, and what parts
   find of it is summed.  In each round, tasks sum a unit's neighbours by class and move it to the class that
   gains most likelihood, measured without its own counts; half of the units move at a time.  Only
   the class of every unit and the table of class bigrams are sent to the tasks.  A round that does
   not raise the likelihood is taken back.  The number of classes grows with the root of the
   vocabulary.  The end of a document is a class of its own and also what precedes its first word.
4. Scores.  log10 P(text) sums class transition (smoothed towards class frequency), unit within
   class, and word within unit.  Words of ending units share the unit by their exact training
   counts; words never seen share the mass of words seen once over an estimated number of such words.

Texts are split once.  Slices of a few megabytes are stored as their distinct words' hashes and a code
for each token; all later steps read these.  Exact counts of all words take one shuffle: slices send
their distinct words to buckets, which keep the words of the vocabulary and answer each slice with the
counts of rarer words over the training documents (see ``chunks``).

Defined results: NULL text is an empty text, which is one end token.  A NULL doc_id has the checksum
of the empty string, so it is a training row.  Repeated rows count each.  Without training rows all
counts are 0 and scores are finite.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymarks.llm.chunks import parts
from waymarks.llm.hashing import finish, pack, unpack
from waymarks.llm.stored import stored, write

#: UTF-8 bytes of an ending.
ENDING = 3
#: Text bytes whose words one bucket receives, about.
BUCKET_BYTES = 48_000_000
SLICE_BYTES = 2_000_000
#: Training tokens of a word from which it has a class of its own.
LEAST = 3
#: Exchange rounds over the whole vocabulary, and (unit, side, class) sums held at once.
ROUNDS = 6
CELLS = 500_000
#: Training text whose neighbours one part holds, about.
PART_BYTES = 3_000_000
#: Training tokens from which a unit's neighbours are dealt over all parts.
WIDE = 250_000
#: Pairs of a part that are summed at once, at least.
JOINED_PAIRS = 500_000
#: Pairs in a stored row, about (12 bytes each), and rows sent to Python at once.
ROW_PAIRS = 1 << 15
BATCH_ROWS = 16

TOKENS = (
    "slice bigint, ids binary, flags binary, sizes binary, words binary, endings binary, counts binary, "
    "at binary, heavy array<struct<ending: boolean, word: binary, n: bigint>>, tokens bigint"
)
SENT = "slice bigint, bucket int, words binary, endings binary, counts binary"
ANSWERS = SENT + ", kinds bigint, once bigint, twice bigint"
PAIRS = "a int, b int, n bigint"
DEALT = "part int, keys binary, counts binary"
CONTEXTS = (
    "wide int, half int, units binary, totals binary, n_after binary, after binary, after_counts binary, "
    "n_before binary, before binary, before_counts binary"
)
MOVES = "unit int, class int"
SUMS = "unit int, cell int, n bigint"
FREQUENCY = "unit int, n bigint"
SUMMED = (
    "slice bigint, ids binary, flags binary, sizes binary, model binary, logs binary, rare_sizes binary, "
    "rare binary, starts binary, distinct bigint"
)
SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, log_counts double, "
    "log_model double, n_seen bigint, n_unseen bigint"
)


def held_out(remainder: int, modulus: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text) % modulus == remainder


class Words:
    """Distinct lower-case words of texts, where each token is among them, and tokens by text."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        # Arrow's ASCII functions change A-Z only and split at U+0009 to U+000D and the space.
        found = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        ends = np.cumsum(pc.list_value_length(found).to_numpy(zero_copy_only=False))
        tokens = found.flatten()
        real = pc.greater(pc.binary_length(tokens), 0)  # blanks at the ends of a text split off ""
        before = np.append(0, np.cumsum(real.to_numpy(zero_copy_only=False)))
        self.sizes = np.diff(before[np.append(0, ends).astype(np.int64)]).astype(np.int64)
        coded = pc.dictionary_encode(tokens.filter(real))
        self.at = coded.indices.to_numpy(zero_copy_only=False)
        self.binary = coded.dictionary.cast(pa.binary())
        self.distinct = self.binary.to_pylist()

    def hashes(self) -> np.ndarray:
        n = len(self.distinct)
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.distinct), np.uint64, n)

    def endings(self) -> np.ndarray:
        """``ending_code`` of the distinct words."""
        if not self.distinct:
            return np.empty(0, np.int32)
        _, offsets, data = self.binary.buffers()
        cuts = np.frombuffer(offsets, np.int32)[self.binary.offset :][: len(self.distinct) + 1]
        data = np.frombuffer(data, np.uint8)
        size = np.minimum(np.diff(cuts), ENDING)
        code = size.astype(np.int32)
        for i in range(ENDING, 0, -1):
            code = code << 8 | np.where(size >= i, data[np.maximum(cuts[1:] - i, 0)], 0)
        return code.astype(np.int32)


def ending_code(word: bytes) -> int:
    """The last bytes of a word and how many they are, as a number."""
    end = word[-ENDING:]
    return len(end) << 8 * ENDING | int.from_bytes(end, "big")


def _ending(code: int) -> bytes:
    size = code >> 8 * ENDING
    return (code & (1 << 8 * ENDING) - 1).to_bytes(size, "big")


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Record batches cut into slices of ``most`` bytes of text, about."""
    for batch in batches:
        size = np.cumsum([len(t.as_buffer() or b"") if t.is_valid else 0 for t in batch["text"]])
        at = 0
        while at < batch.num_rows:
            before = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    # Another mix of the hash deals words to buckets.
    return (finish(hashes * np.uint64(5)) >> np.uint64(33)) % np.uint64(buckets)


def _heavy(words: Words, endings: np.ndarray, n: np.ndarray, share: float) -> list[dict]:
    """Words and endings that make up a quarter of the share of a slice's training tokens."""
    least = max(1, share / 4 * n.sum())
    out = [{"ending": False, "word": words.distinct[i], "n": int(n[i])} for i in np.flatnonzero(n >= least)]
    codes, at = np.unique(endings, return_inverse=True)
    sums = np.bincount(at, n, len(codes)).astype(np.int64)
    often = sums >= least
    of = zip(codes[often].tolist(), sums[often].tolist())
    return out + [{"ending": True, "word": _ending(code), "n": x} for code, x in of]


def _tokens(buckets: int, most: int, share: float):
    """Texts as distinct words, in the order in which buckets receive and answer them, and tokens."""
    heavy = pa.list_(pa.struct([("ending", pa.bool_()), ("word", pa.binary()), ("n", pa.int64())]))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in _slices(batches, most):
            words = Words(batch["text"])
            hashes, endings = words.hashes(), words.endings()
            held = np.array(batch["held_out"].to_pylist(), bool)
            train = np.repeat(~held, words.sizes)
            n = np.bincount(words.at[train], minlength=len(hashes))
            order = np.lexsort((hashes, _bucket(hashes, buckets)))
            place = np.empty(len(order), _code_type(len(order)))
            place[order] = np.arange(len(order))
            ids = batch["doc_id"]
            nameless = ids.is_null().to_numpy(zero_copy_only=False)
            binary = {
                "ids": pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64),
                "flags": held + 2 * nameless.astype(np.uint8),
                "sizes": words.sizes.astype(np.int32),
                "words": pack(hashes[order]),
                "endings": endings[order],
                "counts": n[order].astype(np.uint32),
                "at": place[words.at],
            }
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    *(pa.array([x if isinstance(x, bytes) else x.tobytes()], pa.binary()) for x in binary.values()),
                    pa.array([_heavy(words, endings, n, share)], heavy),
                    pa.array([int(train.sum())], pa.int64()),
                ],
                ["slice", *binary, "heavy", "tokens"],
            )
            number += 1

    return tokens


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch[name][i].as_py() for name in batch.schema.names}


def _code_type(distinct: int):
    return np.uint16 if distinct <= 1 << 16 else np.uint32


def _codes(at: bytes, distinct: int) -> np.ndarray:
    return np.frombuffer(at, _code_type(distinct))


@dataclass
class Units:
    """Ids of frequent words and endings; then the rest, then the end of a text."""

    words: dict[bytes, int]
    endings: dict[bytes, int]

    @property
    def rest(self) -> int:
        return len(self.words) + len(self.endings)

    @property
    def end(self) -> int:
        return self.rest + 1

    def of(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        """Units of words by their hashes and ending codes."""
        codes = {ending_code(e): u for e, u in self.endings.items()}
        out = np.array([codes.get(code, self.rest) for code in endings.tolist()], np.int64)
        for word, unit in self.words.items():
            out[hashes == np.uint64(xxhash.xxh3_64_intdigest(word))] = unit
        return out


def frequent_units(tokens: DataFrame, share: float) -> Units:
    total = tokens.agg(F.sum("tokens")).first()[0] or 0
    found = tokens.select(F.explode("heavy").alias("x")).groupBy("x.ending", "x.word")
    top = found.agg(F.sum("x.n").alias("n")).where(F.col("n") >= 0.75 * share * total)
    # At most 4 / (3 * share) words and as many endings.
    rows = sorted((r.ending, bytes(r.word)) for r in top.collect())
    ids = {key: i for i, key in enumerate(rows)}
    return Units(
        {w: i for (e, w), i in ids.items() if not e}, {w: i for (e, w), i in ids.items() if e}
    )


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(counts: np.ndarray, classes: int, rounds: int = 20) -> np.ndarray:
    """Class of every unit; the last unit (end of text) keeps the last class to itself.

    A unit moves to the class that raises the likelihood of the class bigrams most.  Units start
    dealt round-robin by frequency.
    """
    n = len(counts) - 1
    total = counts.sum(1) + counts.sum(0)
    order = np.argsort(-total[:n], kind="stable")
    k = max(1, min(classes, n)) + 1
    own = np.empty(n + 1, np.int64)
    own[order] = np.arange(n) % (k - 1)
    own[n] = k - 1
    one = np.zeros((n + 1, k))
    one[np.arange(n + 1), own] = 1.0
    table = one.T @ counts @ one
    for _ in range(rounds):
        moved = 0
        for u in order:
            if not total[u]:
                continue
            a = own[u]
            right = np.bincount(own, counts[u], k)  # u, then a class
            left = np.bincount(own, counts[:, u], k)
            loop = counts[u, u]
            right[a] -= loop
            left[a] -= loop
            table[a] -= right
            table[:, a] -= left
            table[a, a] -= loop
            rows, cols = table.sum(1), table.sum(0)
            r, c = right.sum() + loop, left.sum() + loop
            gain = (_xlogx(table + right) - _xlogx(table)).sum(1)
            gain += (_xlogx(table + left[:, None]) - _xlogx(table)).sum(0)
            # The cell of a class with itself gets both shares at once.
            d = np.diag(table)
            gain += _xlogx(d + right + left + loop) - _xlogx(d + right)
            gain += _xlogx(d) - _xlogx(d + left)
            gain -= _xlogx(rows + r) - _xlogx(rows) + _xlogx(cols + c) - _xlogx(cols)
            gain[k - 1] = -np.inf
            best = int(np.argmax(gain))
            if gain[best] <= gain[a] + 1e-9:
                best = a
            table[best] += right
            table[:, best] += left
            table[best, best] += loop
            if best != a:
                own[u] = best
                moved += 1
        if not moved:
            break
    return own


def _send(buckets: int):
    """Training counts of a slice's words to the buckets of the words."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            hashes = unpack(row["words"])
            to, at = np.unique(_bucket(hashes, buckets), return_index=True)
            cuts = [*at.tolist(), len(hashes)]
            spans = list(zip(cuts, cuts[1:]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(to), row["slice"]), pa.int64()),
                    pa.array(to.astype(np.int32)),
                    pa.array([pack(hashes[a:b]) for a, b in spans], pa.binary()),
                    pa.array([row["endings"][4 * a : 4 * b] for a, b in spans], pa.binary()),
                    pa.array([row["counts"][4 * a : 4 * b] for a, b in spans], pa.binary()),
                ],
                ["slice", "bucket", "words", "endings", "counts"],
            )

    return send


def _answer(least: int):
    """Counts below ``least`` of a bucket's words for each slice; the other words in a row of slice -1."""
    kind = np.min_scalar_type(least)

    def answer(table: pa.Table) -> pa.Table:
        words = [unpack(x) for x in table["words"].to_pylist()]
        endings = np.concatenate([np.frombuffer(x, np.int32) for x in table["endings"].to_pylist()])
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()])
        cuts = np.cumsum([len(w) for w in words])[:-1]
        words = np.concatenate(words)
        order = np.argsort(words)
        words = words[order]
        new = np.append(True, words[1:] != words[:-1])
        first = np.flatnonzero(new)
        total = np.add.reduceat(counts[order].astype(np.int64), first)
        given = np.empty(len(words), kind)
        given[order] = np.minimum(total, least).astype(kind)[np.cumsum(new) - 1]
        often = total >= least
        own = [pack(words[first][often]), endings[order[first]][often].tobytes(), total[often].tobytes()]
        n = table.num_rows
        stats = [(total > 0).sum(), (total == 1).sum(), (total == 2).sum()]
        columns = [
            pa.array([-1, *table["slice"].to_pylist()], pa.int64()),
            pa.array([table["bucket"][0].as_py()] * (n + 1), pa.int32()),
            pa.array([own[0]] + [None] * n, pa.binary()),
            pa.array([own[1]] + [None] * n, pa.binary()),
            pa.array([own[2], *(x.tobytes() for x in np.split(given, cuts))], pa.binary()),
            *(pa.array([int(x)] + [0] * n, pa.int64()) for x in stats),
        ]
        names = ["slice", "bucket", "words", "endings", "counts", "kinds", "once", "twice"]
        return pa.Table.from_arrays(columns, names)

    return answer


@dataclass
class Vocabulary:
    """Units of words with enough tokens, by sorted hash; then endings, the rest, the end of a text."""

    hashes: np.ndarray
    endings: dict[bytes, int]

    @property
    def words(self) -> np.ndarray:
        return self.hashes

    @property
    def rest(self) -> int:
        return len(self.hashes) + len(self.endings)

    @property
    def end(self) -> int:
        return self.rest + 1

    def of(self, words: list[bytes], hashes: np.ndarray) -> np.ndarray:
        return self.by_code(hashes, np.array([ending_code(w) for w in words], np.int32))

    def by_code(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        """Units of words by their hashes and ending codes."""
        at = np.searchsorted(self.hashes, hashes)
        own = at < len(self.hashes)
        own[own] = self.hashes[at[own]] == hashes[own]
        found = sorted((ending_code(e), u) for e, u in self.endings.items())
        found.append((1 << 31, self.rest))
        codes, units = np.array(found, np.int64).T
        other = endings[~own]
        place = np.searchsorted(codes, other)
        at[~own] = np.where(codes[place] == other, units[place], self.rest)
        return at


def vocabulary(answers: DataFrame, seed: Units) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """All words with enough training tokens, their units in the seed and their tokens."""
    rows = answers.where("slice < 0").select("words", "endings", "counts").toArrow().to_pylist()
    hashes = np.concatenate([np.empty(0, np.uint64), *(unpack(r["words"]) for r in rows)])
    codes = np.frombuffer(b"".join(r["endings"] for r in rows), np.int32)
    n = np.frombuffer(b"".join(r["counts"] for r in rows), np.int64)
    order = np.argsort(hashes)
    hashes, codes, n = hashes[order], codes[order], n[order]
    first = len(hashes)
    endings = {w: first + i for i, w in enumerate(sorted(seed.endings))}
    return Vocabulary(hashes, endings), seed.of(hashes, codes), n


def _narrow(x: np.ndarray) -> np.ndarray:
    """Bytes of unsigned 64-bit integers, a row each, as many as the largest needs."""
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def _planes(rows: np.ndarray) -> bytes:
    return bytes([rows.shape[1]]) + rows.T.tobytes()


def _wide_again(payload: bytes) -> np.ndarray:
    planes = np.frombuffer(payload, np.uint8, offset=1).reshape(payload[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : payload[0]] = planes.T
    return out.view("<i8").ravel()


def _pairs_of(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(_wide_again(keys)), _wide_again(counts)


def _contexts(shared, count: int):
    """Neighbours of units, (unit, side, neighbour) as one number; side 0 is what follows.

    A unit's neighbours go to one part, those of a wide unit over all parts of wide units.
    """

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, wide = shared.value
        size = units.end + 1
        # Short integers are sorted by radix.
        small = np.uint16 if 2 * count <= 1 << 16 else np.int32
        for row in _rows(batches):
            hashes = unpack(row["words"])
            unit = units.by_code(hashes, np.frombuffer(row["endings"], np.int32))
            unit = unit[_codes(row["at"], len(hashes))]
            sizes = np.frombuffer(row["sizes"], np.int32)
            train = np.frombuffer(row["flags"], np.uint8) % 2 == 0
            unit, sizes = unit[np.repeat(train, sizes)], sizes[train]
            # An end before the first text and after every text.
            flow = np.append(units.end, np.insert(unit, np.cumsum(sizes), units.end))
            pair, n = np.unique(flow[:-1] * size + flow[1:], return_counts=True)
            a = pair // size
            b = pair - a * size
            keys = np.concatenate((2 * a * size + b, (2 * b + 1) * size + a))
            unit, other = np.concatenate((a, b)), np.concatenate((b, a))
            n = np.concatenate((n, n))
            part = (unit + np.where(wide[unit], other, 0)) % count + count * wide[unit]
            order = np.argsort(keys)
            order = order[np.argsort(part[order].astype(small), kind="stable")]
            keys, n, part = keys[order], n[order], part[order]
            at = np.flatnonzero(np.diff(part, prepend=-1))
            steps = np.diff(keys, prepend=0)
            steps[at] = keys[at]
            steps, n = _narrow(steps), _narrow(n)
            spans = list(zip(at.tolist(), [*at[1:].tolist(), len(part)]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[at], pa.int32()),
                    pa.array([_planes(steps[i:j]) for i, j in spans], pa.binary()),
                    pa.array([_planes(n[i:j]) for i, j in spans], pa.binary()),
                ],
                ["part", "keys", "counts"],
            )

    return contexts


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[at], np.add.reduceat(n[order], at)


def _joined(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return _summed(np.concatenate([k for k, _ in lists]), np.concatenate([n for _, n in lists]))


def _merged(size: int, count: int):
    """Sums of a part's lists, in rows of bounded length that keep a unit whole if they can."""

    def merged(table: pa.Table) -> pa.Table:
        # Lists are summed when they hold more pairs than what they were summed to before.
        held: list[tuple[np.ndarray, np.ndarray]] = []
        more = 0
        for keys, counts in zip(table["keys"], table["counts"]):
            held.append(_pairs_of(keys.as_py(), counts.as_py()))
            more += len(held[-1][0])
            if more > max(JOINED_PAIRS, len(held[0][0])):
                held, more = [_joined(held)], 0
        keys, n = _joined(held)
        del held
        wide = int(table["part"][0].as_py() >= count)
        half = keys // (2 * size) // count % 2
        rows = []
        for turn in (0, 1):
            own, sums = keys[half == turn], n[half == turn]
            # A row begins with the first unit that begins in each stretch of ROW_PAIRS pairs.
            first = np.flatnonzero(np.diff(own // (2 * size), prepend=-1))
            cuts = first[np.flatnonzero(np.diff(first // ROW_PAIRS, prepend=0))]
            pieces = zip(np.split(own, cuts), np.split(sums, cuts))
            rows += [(wide, turn, *_row(*x, size)) for x in pieces if len(x[0])]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 8]
        columns = list(zip(*rows)) or [[]] * len(kinds)
        names = [x.split()[0] for x in CONTEXTS.split(", ")]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return merged


def _row(keys: np.ndarray, n: np.ndarray, size: int) -> list[bytes]:
    """Units, how often each is met, and for either side how many neighbours, which and how often."""
    of = keys // size
    other, unit, side = keys - of * size, of >> 1, of & 1
    start = _starts(unit)
    at = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(unit))))
    before = side == 1
    totals = np.bincount(at[before], n[before], len(start)).astype(np.int64)
    out = [unit[start].astype(np.int32).tobytes(), totals.tobytes()]
    for here in (~before, before):
        # Differences wrap at 32 bits.
        steps = np.diff(other[here].astype(np.uint32), prepend=np.uint32(0))
        out.append(np.bincount(at[here], minlength=len(start)).astype(np.int32).tobytes())
        out.append(steps.view(np.uint8).reshape(-1, 4).T.tobytes())
        out.append(_planes(_narrow(n[here])))
    return out


def _side(lengths: bytes, others: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = np.ascontiguousarray(np.frombuffer(others, np.uint8).reshape(4, -1).T).view(np.uint32)
    return np.frombuffer(lengths, np.int32), np.cumsum(steps.ravel(), dtype=np.uint32), _wide_again(counts)


def _in_small_batches(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """``df``, stored and read by a session of its own that sends few rows at once to Python; its path."""
    # Parquet looks at the size of pages and row groups only every 100 rows, unless told otherwise.
    options = {
        "parquet.block.size": BATCH_ROWS * ROW_PAIRS * 12,
        "parquet.block.size.row.check.min": BATCH_ROWS,
        "parquet.page.size.row.check.min": 1,
        "parquet.enable.dictionary": "false",
    }
    path = write(df, name, by, **options)
    session = df.sparkSession.newSession()
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    session.conf.set("spark.sql.shuffle.partitions", df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return session.read.schema(df.schema).parquet(path), path


def _frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = np.frombuffer(b"".join(batch["units"].to_pylist()), np.int32)
        totals = np.frombuffer(b"".join(batch["totals"].to_pylist()), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(units), pa.array(totals)], ["unit", "n"])


def _class_pairs(shared):
    def class_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        k = int(own[-1]) + 1
        table = np.zeros(k * k)
        for row in _rows(batches):
            units = np.frombuffer(row["units"], np.int32)
            lengths, after, n = _side(row["n_after"], row["after"], row["after_counts"])
            cell = np.repeat(own[units] * k, lengths) + own[after]
            table += np.bincount(cell, n, k * k)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(at // k, pa.int32()),
                pa.array(at % k, pa.int32()),
                pa.array(table[at].astype(np.int64)),
            ],
            ["a", "b", "n"],
        )

    return class_pairs


def _best(own, table, right, left):
    """Best class of units in classes ``own`` with neighbour counts; a unit's own counts left out."""
    k, few = len(table), 0.5
    rows, cols = table.sum(1), table.sum(0)
    logs = np.log(table + few)
    r, c = right.sum(1), left.sum(1)
    gain = right @ logs.T + left @ logs
    gain -= r[:, None] * np.log(rows + k * few) + c[:, None] * np.log(cols + k * few)
    gain[:, k - 1] = -np.inf  # the end of a text
    stay = (right * np.log(np.maximum(table[own] - right, 0) + few)).sum(1)
    stay += (left * np.log(np.maximum(table.T[own] - left, 0) + few)).sum(1)
    stay -= r * np.log(np.maximum(rows[own] - r, 0) + k * few)
    stay -= c * np.log(np.maximum(cols[own] - c, 0) + k * few)
    gain[np.arange(len(own)), own] = stay
    best = gain.argmax(1)
    return np.where(gain[np.arange(len(own)), best] > stay + 1e-9, best, own)


def _starts(sorted_values: np.ndarray) -> np.ndarray:
    """Where each distinct value begins."""
    return np.flatnonzero(np.diff(sorted_values, prepend=-1))


def _class_sums(batches: Iterator[pa.RecordBatch], own: np.ndarray, k: int):
    """Units and how often each has neighbours of a class, what follows it first."""
    at_once = max(1, CELLS // (2 * k))
    for row in _rows(batches):
        units = np.frombuffer(row["units"], np.int32)
        sides = [
            _side(row["n_after"], row["after"], row["after_counts"]),
            _side(row["n_before"], row["before"], row["before_counts"]),
        ]
        ends = [np.append(0, np.cumsum(lengths)) for lengths, _, _ in sides]
        for i in range(0, len(units), at_once):
            part = units[i : i + at_once]
            sums = []
            for (lengths, other, n), end in zip(sides, ends):
                a, b = end[i], end[i + len(part)]
                cell = np.repeat(np.arange(len(part)) * k, lengths[i : i + at_once]) + own[other[a:b]]
                sums.append(np.bincount(cell, n[a:b], len(part) * k).reshape(-1, k))
            yield part, *sums


def _chosen(units: np.ndarray, best: np.ndarray, own: np.ndarray, names=("unit", "class")):
    moved = best != own[units]
    return [pa.array(units[moved], pa.int32()), pa.array(best[moved], pa.int32())], list(names)


def _moves(shared):
    """Moves of units whose neighbours are in one part."""

    def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = shared.value
        for units, right, left in _class_sums(batches, own, len(table)):
            best = _best(own[units], table, right, left)
            yield pa.RecordBatch.from_arrays(*_chosen(units, best, own))

    return moves


def _wide_sums(shared):
    """Neighbours of wide units by class, as far as a task holds them."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = shared.value
        k = len(table)
        held, more = [(np.empty(0, np.int64), np.empty(0, np.int64))], 0

        def out():
            cells, n = _joined(held)
            return pa.RecordBatch.from_arrays(
                [pa.array(cells // (2 * k), pa.int32()), pa.array(cells % (2 * k), pa.int32()), pa.array(n)],
                ["unit", "cell", "n"],
            )

        for units, right, left in _class_sums(batches, own, k):
            free = units < len(own) - 1  # the end stays
            sums = np.hstack((right, left))[free]
            at, cell = np.nonzero(sums)
            held.append((units[free][at].astype(np.int64) * 2 * k + cell, sums[at, cell].astype(np.int64)))
            more += len(at)
            if more > CELLS:
                held = [_joined(held)]
                more = 0
                if len(held[0][0]) > CELLS:
                    yield out()
                    held = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        yield out()

    return sums


def _wide_move(shared):
    def move(sums: pa.Table) -> pa.Table:
        own, table = shared.value
        k = len(table)
        unit = sums["unit"].to_numpy()[:1]
        row = np.bincount(sums["cell"].to_numpy(), sums["n"].to_numpy().astype(float), 2 * k)
        best = _best(own[unit], table, row[None, :k], row[None, k:])
        return pa.Table.from_arrays(*_chosen(unit, best, own))

    return move


def _moved(contexts: DataFrame, own: np.ndarray, table: np.ndarray, turn: int):
    """(unit, class) of the moves of a turn."""
    shared = contexts.sparkSession.sparkContext.broadcast((own, table))
    free = contexts.where(F.col("half") == turn % 2)
    columns = [c for c in contexts.columns if c not in ("wide", "half", "totals")]
    whole = free.where("wide = 0").select(*columns).mapInArrow(_moves(shared), MOVES)
    wide = free.where("wide = 1").select(*columns).mapInArrow(_wide_sums(shared), SUMS)
    wide = wide.groupBy("unit", "cell").agg(F.sum("n").alias("n"))
    wide = wide.groupBy("unit").applyInArrow(_wide_move(shared), MOVES)
    rows = whole.union(wide).toArrow()
    shared.destroy()
    return rows["unit"].to_numpy(), rows["class"].to_numpy()


def _class_table(contexts: DataFrame, own: np.ndarray) -> np.ndarray:
    shared = contexts.sparkSession.sparkContext.broadcast(own)
    rows = contexts.select("units", "n_after", "after", "after_counts").mapInArrow(_class_pairs(shared), PAIRS)
    rows = rows.groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((int(own[-1]) + 1,) * 2)
    table[rows["a"].to_numpy(), rows["b"].to_numpy()] = rows["n"].to_numpy()
    shared.destroy()
    return table


def likelihood(table: np.ndarray) -> float:
    """Log likelihood of class bigrams, but for what no clustering changes."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum())


def exchange_rounds(
    contexts: DataFrame, own: np.ndarray, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all units and the table of class bigrams after exchange rounds in Spark."""
    table, failed = _class_table(contexts, own), 0
    for turn in range(rounds):
        units, classes = _moved(contexts, own, table, turn)
        new = own.copy()
        new[units] = classes
        after = _class_table(contexts, new) if len(units) else table
        if likelihood(after) > likelihood(table):
            own, table, failed = new, after, 0
        else:
            failed += 1
        if failed == 2:  # neither half has a move that gains
            break
    return own, table


@dataclass
class Model:
    """Log10 probabilities of the class model, but for the words of ending units."""

    units: Vocabulary
    own: np.ndarray  # class of a unit
    step: np.ndarray  # log10 P(class | class before)
    within: np.ndarray  # log10 P(unit | class)
    frequency: np.ndarray  # training tokens of a unit


def class_count(words: int, classes: int) -> int:
    return max(classes, math.isqrt(words) // 8)


def seed_units(seed: Units, units: Vocabulary, of: np.ndarray) -> np.ndarray:
    """The seed's unit of every unit."""
    out = np.empty(units.end + 1, np.int64)
    out[: len(of)] = of
    for word, unit in units.endings.items():
        out[unit] = seed.endings[word]
    out[units.rest], out[units.end] = seed.rest, seed.end
    return out


def first_classes(seed: Units, counts: np.ndarray, of: np.ndarray, n: np.ndarray, classes: int):
    """Classes before the first round: those of the seed; other words are dealt by frequency."""
    k = class_count(len(n), classes)
    seeded = exchange(counts, k, rounds=8)
    own = seeded[of]
    order = np.argsort(-n, kind="stable")
    dealt = np.empty(len(n), np.int64)
    dealt[order] = np.arange(len(n)) % k
    # Ids of the seed's words come before those of its endings.
    own[: len(n)] = np.where(of[: len(n)] < len(seed.words), own[: len(n)], dealt)
    own[-1] = k
    return own


@dataclass
class Split:
    """Stored slices of split documents."""

    tokens: DataFrame  # few rows at once to Python
    path: str
    train_bytes: int
    buckets: int


def split(docs: DataFrame, share: float, most: int = SLICE_BYTES, bucket_bytes: int = BUCKET_BYTES) -> Split:
    """The slices of ``docs`` (doc_id, text, held_out)."""
    size = F.octet_length("text")
    sizes = docs.agg(F.sum(size), F.sum(F.when(~F.col("held_out"), size))).first()
    buckets = parts(sizes[0] or 0, bucket_bytes)
    tokens = docs.select("doc_id", "text", "held_out").mapInArrow(_tokens(buckets, most, share), TOKENS)
    return Split(*_in_small_batches(tokens, "tokens"), sizes[1] or 0, buckets)


def counted(slices: Split, least: int) -> DataFrame:
    """Answers of the buckets."""
    sent = slices.tokens.select("slice", "words", "endings", "counts").mapInArrow(_send(slices.buckets), SENT)
    return stored(sent.groupBy("bucket").applyInArrow(_answer(least), ANSWERS), "answers")


def fit(
    train: DataFrame, share: float, classes: int, least: int = LEAST, weight: float = 50.0
) -> Model:
    """The model of all rows of ``train``."""
    docs = train.select(F.lit(None).cast("bigint").alias("doc_id"), "text", F.lit(False).alias("held_out"))
    slices = split(docs, share)
    return learn(slices, counted(slices, least), share, classes, weight)


def learn(slices: Split, answers: DataFrame, share: float, classes: int, weight: float = 50.0) -> Model:
    seed = frequent_units(slices.tokens, share)
    units, of, n = vocabulary(answers, seed)
    count = parts(slices.train_bytes, PART_BYTES)
    wide = np.append(n >= WIDE, np.ones(units.end + 1 - len(n), bool))
    shared = slices.tokens.sparkSession.sparkContext.broadcast((units, wide))
    sent = slices.tokens.select("flags", "sizes", "words", "endings", "at")
    sent = sent.mapInArrow(_contexts(shared, count), DEALT)
    merged = sent.groupBy("part").applyInArrow(_merged(units.end + 1, count), CONTEXTS)
    contexts, _ = _in_small_batches(merged, "contexts", ("wide", "half"))
    rows = contexts.select("units", "totals").mapInArrow(_frequency, FREQUENCY)
    rows = rows.groupBy("unit").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(units.end + 1)
    frequency[rows["unit"].to_numpy()] = rows["n"].to_numpy()
    of = seed_units(seed, units, of)
    own = first_classes(seed, _class_table(contexts, of), of, n, classes)
    own, table = exchange_rounds(contexts, own)
    # Every unit is possible: one more count for each.
    mass = np.bincount(own, frequency + 1.0, len(table))
    prior = np.maximum(mass / mass.sum(), 1e-300)  # a class without units is never met
    step = (table + weight * prior) / (table.sum(1, keepdims=True) + weight)
    within = (frequency + 1.0) / mass[own]
    return Model(units, own, np.log10(step), np.log10(within), frequency)


def _score(shared, buckets: int):
    """Sums of documents, but for words without a unit of their own: those go on by their place."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        units = model.units
        for row in _rows(batches):
            hashes = unpack(row["words"])
            sizes = np.frombuffer(row["sizes"], np.int32).astype(np.int64)
            at = _codes(row["at"], len(hashes))
            unit = units.by_code(hashes, np.frombuffer(row["endings"], np.int32))
            # A word with a unit of its own has the unit's tokens.
            share = np.log10(model.frequency[unit] + 1.0)[at]
            unit = unit[at]
            # The flow of units with an end before each document and after the last.
            ends = np.cumsum(sizes)
            flow = np.insert(unit, ends - sizes, units.end) if len(sizes) else unit
            flow = np.append(flow, units.end)
            kind = model.own[flow]
            step = model.step[kind[:-1], kind[1:]] + model.within[flow[1:]]
            doc = np.repeat(np.arange(len(sizes)), sizes)
            docs_of = np.repeat(np.arange(len(sizes)), sizes + 1)
            rare = unit >= len(units.words)

            def per_doc(of: np.ndarray, x: np.ndarray | None = None) -> np.ndarray:
                return np.bincount(of, x, len(sizes))

            sums = {
                "model": per_doc(docs_of, step) - per_doc(doc[rare], share[rare]),
                "logs": per_doc(doc[~rare], share[~rare]),
                "rare_sizes": per_doc(doc[rare]).astype(np.int32),
                "rare": at[rare],
                "starts": np.searchsorted(_bucket(hashes, buckets), np.arange(buckets)),
            }
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["slice"]], pa.int64()),
                    *(pa.array([row[c]], pa.binary()) for c in ("ids", "flags", "sizes")),
                    *(pa.array([x.tobytes()], pa.binary()) for x in sums.values()),
                    pa.array([len(hashes)], pa.int64()),
                ],
                ["slice", "ids", "flags", "sizes", *sums, "distinct"],
            )

    return score


def _with_rare(least: int):
    """Sums of documents with the counts of all words."""
    sent = np.min_scalar_type(least)

    def with_rare(slices: pa.Table, answers: pa.Table) -> pa.Table:
        row = slices.to_pylist()[0]
        known = np.zeros(row["distinct"], sent)
        starts = np.frombuffer(row["starts"], np.int64)
        for bucket, payload in zip(answers["bucket"].to_pylist(), answers["counts"].to_pylist()):
            n = np.frombuffer(payload, sent)
            known[starts[bucket] : starts[bucket] + len(n)] = n
        n = known[_codes(row["rare"], row["distinct"])].astype(np.int64)
        sizes = np.frombuffer(row["sizes"], np.int32).astype(np.int64)
        rare = np.frombuffer(row["rare_sizes"], np.int32)
        flags = np.frombuffer(row["flags"], np.uint8)
        doc = np.repeat(np.arange(len(sizes)), rare)

        def per_doc(x: np.ndarray) -> np.ndarray:
            return np.bincount(doc, x, len(sizes))

        seen = per_doc(n > 0).astype(np.int64)
        logs = np.frombuffer(row["logs"]) + per_doc(np.log10(n + 1.0))
        model = np.frombuffer(row["model"]) + per_doc(np.log10(np.maximum(n, 1)))
        return pa.table(
            {
                "doc_id": pa.array(np.frombuffer(row["ids"], np.int64), mask=flags >= 2),
                "held_out": pa.array(flags % 2 == 1),
                "n_tokens": pa.array(sizes + 1, pa.int64()),
                "n_known": pa.array(sizes - rare + seen, pa.int64()),
                "log_counts": pa.array(logs, pa.float64()),
                "log_model": pa.array(model, pa.float64()),
                "n_seen": pa.array(seen, pa.int64()),
                "n_unseen": pa.array(rare - seen, pa.int64()),
            }
        )

    return with_rare


def class_scores(
    docs: DataFrame,
    held: Column,
    share: float = 1 / 2000,
    classes: int = 32,
    chunk_bytes: int = SLICE_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Scores of every row of ``docs`` under a model of the rows where ``held`` is false.

    Returns doc_id, held_out, n_tokens, n_known (tokens with training counts), train_tokens,
    base_score (add-one unigram log10 probability), score (log10 probability of the class model)
    and perplexity.  ``share`` bounds the seed of the clustering and the endings of rare words, not
    the vocabulary; ``classes`` is the least number of classes.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), "text", held.alias("held_out"))
    slices = split(docs, share, chunk_bytes, bucket_bytes)
    answers = counted(slices, LEAST)
    model = learn(slices, answers, share, classes)
    units = model.units
    shared = docs.sparkSession.sparkContext.broadcast(model)
    stats = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("kinds", "once", "twice"))).first()
    kinds, once, twice = stats
    tokens = docs.sparkSession.read.schema(slices.tokens.schema).parquet(slices.path)
    scored = (
        tokens.select("slice", "ids", "flags", "sizes", "words", "endings", "at")
        .mapInArrow(_score(shared, slices.buckets), SUMMED)
        .groupBy("slice")
        .cogroup(answers.where("slice >= 0").select("slice", "bucket", "counts").groupBy("slice"))
        .applyInArrow(_with_rare(LEAST), SCORED)
    )
    ends = float(model.frequency[units.end])
    total = int(model.frequency.sum())
    rare = float(model.frequency[len(units.words) : units.end].sum())
    # Words seen once over all rare tokens: the mass of unseen words, over their estimated number.
    missing = (once + 0.5) / (rare + 1.5)
    unseen = max((once + 0.5) * (once + 0.5) / (2 * twice + 1), 1.0)
    each = min(missing * max(rare, 1.0) / unseen, 1.0)
    score = (
        F.col("log_model")
        + F.col("n_seen") * math.log10(max(1 - missing, 1e-9))
        + F.col("n_unseen") * math.log10(each)
    )
    kinds += int(ends > 0)
    base = F.col("log_counts") + F.lit(math.log10(ends + 1))
    base = base - F.col("n_tokens") * math.log10(total + kinds + 1)
    out = scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        score.alias("score"),
    )
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
