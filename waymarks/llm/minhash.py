"""MinHash near-dedup with tensored banding.

A document's set holds its distinct word shingles.  Two small collections of ``bands`` partial keys
are computed, each key from ``rows`` minhashes; every pair of a partial key of the first and one of
the second collection is a table key.  ``2 * bands * rows`` minhashes so serve ``bands ** 2`` tables
of ``2 * rows`` rows each.  At similarity 0.75 a pair of sets shares a table with probability
``(1 - (1 - 0.75**rows)**bands)**2``, 0.9995 by default.  A partial key that only one set has cannot
be part of a shared table key, so partial keys are counted first and few table keys are built.

Candidates are confirmed on the full sets.  Copies (equal sets) fold into their smallest id first.
Then every document is compared with the bucket leader it shares most tables with, and next with its
other leaders.  Documents of buckets that still span several components meet once more, in blocks of
bounded size inside tasks: pairs that share a table, lie in different components, and pass an estimate
from further minhashes (which a similar pair fails once in about 100,000) are confirmed too.  Pairs
inside a component are never built, so a large group of near copies costs a few comparisons a member,
and no candidate is left out.

Defined results: NULL text, and text without words, is an empty set, linked with nothing.  With
fewer words than a shingle the whole sequence is the one shingle.  Rows with one doc_id are one
document.  A row without doc_id is linked with nothing; its component_id is NULL and it is kept.  An
empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymarks.llm.components import components
from waymarks.llm.hashing import BASE_A, BASE_B, WordHashes, finish, rolling
from waymarks.llm.stored import stored

#: Documents in a block; two blocks are compared at a time.
BLOCK = 1024
#: Minhashes of the estimate that pairs must pass before their full sets meet.
ESTIMATE = 128

SKETCH = "doc_id bigint, n_shingles bigint, fp binary, a array<bigint>, b array<bigint>"
SETS = "doc bigint, shingles binary"
FOUND = "u bigint, v bigint"
BUSY = (
    "i int, part bigint, x int, y int, own int, doc bigint, n bigint, component bigint, "
    "a array<bigint>, b array<bigint>, estimate binary"
)
ROWS = "doc bigint, n bigint, component bigint, a array<bigint>, b array<bigint>, estimate binary"


def _split_lower(text: str) -> list[bytes]:
    # bytes.lower() changes A-Z only.
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_sets(texts: list[str | None], width: int, hashes: WordHashes) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    words = [[] if t is None else _split_lower(t) for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    tokens = [hashes.array(w) for w in words]
    joined = np.concatenate(tokens) if tokens else np.empty(0, np.uint64)
    rolled = rolling(joined, width)
    out, at = [], 0
    for n, own in zip(lengths, tokens):
        if n >= width:
            out.append(np.unique(rolled[at : at + n - width + 1]))
        elif n:
            short = rolling(own, int(n), BASE_B)
            out.append(finish(short + np.uint64(n)))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def _batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of few rows, so that the arrays of a slice stay small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _sketch(width: int, bands: int, rows: int):
    salt = np.random.default_rng(20240229)
    count = 2 * bands * rows
    xor = salt.integers(0, 1 << 63, count, np.uint64)
    times = salt.integers(0, 1 << 62, count, np.uint64) * np.uint64(2) + np.uint64(1)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in _batches(batches, 500):
            sets = shingle_sets(batch["text"].to_pylist(), width, hashes)
            n = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(n)
            a = [None] * len(sets)
            b = [None] * len(sets)
            prints = [None] * len(sets)
            if len(full):
                x = np.concatenate([sets[i] for i in full])
                at = np.cumsum(n[full]) - n[full]
                sums = [
                    np.add.reduceat(finish(x * np.uint64(m)), at) + n[full].astype(np.uint64)
                    for m in (BASE_A, BASE_B)
                ]
                low = [np.minimum.reduceat((x ^ c) * m, at) for c, m in zip(xor, times)]
                keys = []
                for k in range(0, count, rows):
                    key = np.full(len(full), k, np.uint64)
                    for one in low[k : k + rows]:
                        key = finish(key * np.uint64(BASE_A) + one)
                    keys.append(key.view(np.int64))
                keys = np.stack(keys, 1)
                for row, i in enumerate(full):
                    a[i], b[i] = keys[row, :bands], keys[row, bands:]
                    prints[i] = sums[0][row].tobytes() + sums[1][row].tobytes()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"].cast(pa.int64()),
                    "n_shingles": pa.array(n, pa.int64()),
                    "fp": pa.array(prints, pa.binary()),
                    "a": pa.array(a, pa.list_(pa.int64())),
                    "b": pa.array(b, pa.list_(pa.int64())),
                }
            )

    return sketch


def _sets(width: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in _batches(batches, 500):
            found = shingle_sets(batch["text"].to_pylist(), width, hashes)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc": batch["doc_id"].cast(pa.int64()),
                    "shingles": pa.array([s.tobytes() for s in found], pa.binary()),
                }
            )

    return sets


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    union = np.concatenate((x, y))
    union.sort(kind="stable")  # two sorted runs merge
    both = int((union[1:] == union[:-1]).sum())
    return 100 * both >= percent * (len(union) - both)


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, 1000):
            u, v = batch["u"].to_pylist(), batch["v"].to_pylist()
            keep = []
            for i, (x, y) in enumerate(zip(batch["x"], batch["y"])):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                if _similar(x, y, percent):
                    keep.append(i)
            yield pa.RecordBatch.from_pydict(
                {
                    "u": pa.array([u[i] for i in keep], pa.int64()),
                    "v": pa.array([v[i] for i in keep], pa.int64()),
                }
            )

    return confirm


def _estimates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Eight bits of each of ESTIMATE further minhashes, computed for few documents only."""
    salt = np.random.default_rng(77)
    xor = salt.integers(0, 1 << 63, ESTIMATE, np.uint64)
    times = salt.integers(0, 1 << 62, ESTIMATE, np.uint64) * np.uint64(2) + np.uint64(1)
    for batch in _batches(batches, 500):
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch["shingles"]]
        n = np.array([len(x) for x in sets])
        joined, at = np.concatenate(sets), np.cumsum(n) - n
        low = [
            finish(np.minimum.reduceat((joined ^ c) * m, at)).astype(np.uint8)
            for c, m in zip(xor, times)
        ]
        columns = {c: batch[c] for c in ("doc", "n", "component", "a", "b")}
        columns["estimate"] = pa.array([x.tobytes() for x in np.stack(low, 1)], pa.binary())
        yield pa.RecordBatch.from_pydict(columns)


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def _likely(table: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs of a block that may be links across components."""
    # Similar sets agree in this many of the estimate's values but for one pair in about 100,000.
    p = percent / 100
    least = int(ESTIMATE * p - 4.2 * (ESTIMATE * p * (1 - p)) ** 0.5)
    i, x, y = (table[c][0].as_py() for c in ("i", "x", "y"))
    doc, n, comp = (table[c].to_numpy() for c in ("doc", "n", "component"))
    if len(np.unique(comp)) < 2:
        return
    a, b = _matrix(table["a"]), _matrix(table["b"])
    est = np.frombuffer(b"".join(table["estimate"].to_pylist()), np.uint8)
    est = est.reshape(len(doc), ESTIMATE)
    own = table["own"].to_numpy()
    left = np.flatnonzero(own == x)
    right = left if x == y else np.flatnonzero(own == y)
    for at in range(0, len(left), 256):
        r = left[at : at + 256]
        ok = comp[r][:, None] != comp[right]
        low, high = np.minimum.outer(n[r], n[right]), np.maximum.outer(n[r], n[right])
        ok &= 100 * low >= percent * high
        if x == y:
            ok &= doc[r][:, None] > doc[right]
        for k in range(i):  # a pair belongs to the first partial key it shares
            ok &= a[r, k][:, None] != a[right, k]
        shared = np.zeros(ok.shape, bool)
        for k in range(b.shape[1]):
            shared |= b[r, k][:, None] == b[right, k]
        e, f = np.nonzero(ok & shared)
        e, f = r[e], right[f]
        for cut in range(0, len(e), 1 << 16):
            g, h = e[cut : cut + (1 << 16)], f[cut : cut + (1 << 16)]
            like = (est[g] == est[h]).sum(1) >= least
            yield g[like], h[like]


def _busy(percent: int):
    def busy(table: pa.Table) -> pa.Table:
        hit = np.zeros(len(table), bool)
        for g, h in _likely(table, percent):
            hit[g] = hit[h] = True
        return table.filter(pa.array(hit))

    return busy


def _confirm_block(percent: int):
    def confirm(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
        doc, u, v = table["doc"].to_numpy(), [], []
        for g, h in _likely(table, percent):
            for e, f in zip(g.tolist(), h.tolist()):
                if _similar(sets[e], sets[f], percent):
                    u.append(max(doc[e], doc[f]))
                    v.append(min(doc[e], doc[f]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return confirm


class Candidates:
    """Shared buckets of representatives, and the sets that confirm links."""

    def __init__(self, docs: DataFrame, sketches: DataFrame, width: int, bands: int, percent: int):
        self.percent = percent
        named = sketches.where("doc_id IS NOT NULL AND fp IS NOT NULL")
        self.reps = stored(
            # Copies agree in all but the id.
            named.groupBy("fp").agg(
                F.min("doc_id").alias("doc_id"),
                *(F.first(c).alias(c) for c in ("n_shingles", "a", "b")),
            ),
            "reps",
        )
        self.members = stored(self._shared(), "members")
        wanted = self.members.select(F.col("doc").alias("_doc")).distinct()
        text = docs.select(F.col("doc_id").cast("bigint"), "text").join(
            wanted, F.col("doc_id") == F.col("_doc"), "left_semi"
        )
        sets = text.mapInArrow(_sets(width), SETS)
        # Rows that share a doc_id: the set of any one of them, the same on each run.
        self.sets = stored(sets.groupBy("doc").agg(F.min("shingles").alias("shingles")), "sets")

    def _shared(self) -> DataFrame:
        """(key, doc, n, size, leader) of every table key that two or more sets have."""
        r = self.reps
        half = [
            r.select("doc_id", "n_shingles", F.lit(s).alias("side"), F.explode(s).alias("part"))
            for s in ("a", "b")
        ]
        parts = half[0].union(half[1])
        common = parts.groupBy("side", "part").count().where("count > 1").drop("count")
        own = (
            parts.join(common, ["side", "part"])
            .groupBy("doc_id")
            .agg(
                F.first("n_shingles").alias("n"),
                F.collect_list(F.when(F.col("side") == "a", F.col("part"))).alias("a"),
                F.collect_list(F.when(F.col("side") == "b", F.col("part"))).alias("b"),
            )
        )
        entries = (
            own.select("doc_id", "n", F.explode("a").alias("p"), "b")
            .select("doc_id", "n", "p", F.explode("b").alias("q"))
            .select(F.xxhash64("p", "q").alias("key"), F.col("doc_id").alias("doc"), "n")
        )
        buckets = entries.groupBy("key").agg(
            F.count("*").alias("size"), F.min("doc").alias("leader")
        )
        return entries.join(buckets.where("size > 1"), "key")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) that are similar enough on their full sets."""
        x = self.sets.select(F.col("doc").alias("u"), F.col("shingles").alias("x"))
        y = self.sets.select(F.col("doc").alias("v"), F.col("shingles").alias("y"))
        pairs = pairs.where("u <> v").join(x, "u").join(y, "v")
        return pairs.select("u", "v", "x", "y").mapInArrow(_confirm(self.percent), FOUND)

    def labelled(self, labels: DataFrame) -> DataFrame:
        """Members with their components, of the buckets that span several components."""
        m = self.members.join(labels.withColumnRenamed("node", "doc"), "doc", "left")
        m = m.withColumn("component", F.coalesce("component", "doc"))
        mixed = m.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        )
        return m.join(mixed.where("low < high").select("key"), "key")

    def components(self) -> DataFrame:
        """(node, component) of the representatives that have links."""
        ties = self.members.where("doc <> leader").groupBy("doc", "leader").count()
        best = ties.groupBy("doc").agg(
            F.max_by("leader", F.struct("count", -F.col("leader"))).alias("leader")
        )
        edges = stored(self.links(best.toDF("u", "v")), "links")
        labels = components(edges)

        open_ = stored(self.labelled(labels), "open")
        if open_.isEmpty():
            return labels
        rest = open_.where("doc <> leader").select("doc", "leader", "component").distinct()
        of_leader = labels.select(F.col("node").alias("leader"), F.col("component").alias("lead"))
        rest = rest.join(of_leader, "leader", "left").where(
            F.col("component") != F.coalesce("lead", "leader")
        )
        edges = edges.union(stored(self.links(rest.select("doc", "leader").toDF("u", "v")), "links"))
        labels = components(edges)

        open_ = stored(self.labelled(labels).select("doc", "n", "component").distinct(), "open")
        if open_.isEmpty():
            return labels
        return components(edges.union(stored(self._rest(open_), "links")))

    def _rest(self, open_: DataFrame) -> DataFrame:
        """Links (u, v) across components, of documents whose buckets span several.

        Documents meet by a partial key of the first collection, in blocks of bounded size, and are
        a pair if they share one of the second, so all their common tables are met at once.
        """
        keys = self.reps.select(F.col("doc_id").alias("doc"), "a", "b")
        rows = open_.join(keys, "doc").join(self.sets, "doc")
        rows = rows.select("doc", "n", "component", "a", "b", "shingles")
        rows = stored(rows.mapInArrow(_estimates, ROWS), "estimates")
        met = rows.select("*", F.posexplode("a").alias("i", "part"))
        groups = met.groupBy("i", "part").agg(
            F.count("*").alias("size"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        groups = groups.where("low < high").select(
            "i", "part", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")
        )
        met = met.join(groups, ["i", "part"])
        own = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
        met = met.withColumn("own", own)
        met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        met = met.withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other"))
        met = met.select("i", "part", "x", "y", "own", "doc", "n", "component", "a", "b", "estimate")
        group = ["i", "part", "x", "y"]
        # Tasks name the documents that have a likely partner, not the pairs; only those fetch their
        # sets, once a block, and the block finds the pairs again and confirms them.
        busy = stored(met.groupBy(*group).applyInArrow(_busy(self.percent), BUSY), "busy")
        busy = busy.join(self.sets, "doc").select(*busy.columns, "shingles")
        return busy.groupBy(*group).applyInArrow(_confirm_block(self.percent), FOUND)


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 75, bands: int = 10, rows: int = 2
) -> DataFrame:
    """Each row's doc_id, n_shingles, component_id (smallest linked id) and kept."""
    plain = docs.select(F.col("doc_id").cast("bigint"), "text")
    sketches = stored(plain.mapInArrow(_sketch(width, bands, rows), SKETCH), "sketches")
    found = Candidates(plain, sketches, width, bands, percent)
    labels = found.components()
    groups = found.reps.select("fp", F.col("doc_id").alias("rep")).join(
        labels, F.col("rep") == F.col("node"), "left"
    )
    groups = groups.select("fp", F.coalesce("component", "rep").alias("component_id"))
    out = sketches.select("doc_id", "n_shingles", "fp").join(groups, "fp", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs``, all columns as they are, with one document of each group.

    Of rows with one doc_id one stays; rows without doc_id all stay.
    """
    gone = near_duplicates(docs, **options).where("NOT kept").select(F.col("doc_id").alias("gone"))
    # Rows travel as one value, so that no name of theirs meets a name used here.
    own = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    rows = docs.select(F.struct(*own).alias("doc"))
    rows = rows.join(gone.distinct(), F.col("doc.doc_id") == F.col("gone"), "left_anti")
    # Rows without doc_id are spread, each a group of its own.
    alone = F.when(F.col("doc.doc_id").isNull(), F.monotonically_increasing_id())
    same = Window.partitionBy("doc.doc_id", "alone").orderBy(F.xxhash64("doc.text"))
    rows = rows.withColumn("alone", alone).withColumn("row", F.row_number().over(same))
    return rows.where("row = 1").select("doc.*")
