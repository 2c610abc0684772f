"""Embedding near-dedup by Euclidean p-stable hashing.

Normalised vectors are projected on Gaussian directions, shifted and cut into cells of ``width``.  A
table's key joins ``k`` cells; there are ``tables`` tables.  Both follow from the number of distinct
vectors: unrelated vectors seldom share a key, and a pair at the threshold shares one with a
probability of 0.999.

Equal vectors fold into one class first.  The members of a bucket meet in blocks of bounded size
inside tasks, where the cosine of every pair is computed in double precision.  A pair is judged in the
first table it shares, so links are counted, not listed: what leaves a task is one count and at most
one link to the smallest member of its group for each vector, even if all of a block are alike.

Defined results: a vector that is NULL or zero, or has a NULL or non-finite component, has no links and
is kept.  Vectors of different length never link.  Rows with one vec_id and one vector count once.
A NULL vec_id is linked with nothing, has a NULL component_id and is kept.  An empty table gives an
empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from waymarks.llm.components import components
from waymarks.llm.hashing import BASE_A, finish
from waymarks.llm.stored import stored

WIDTH = 2.0
RECALL = 0.999
#: Members of a block; two blocks meet in one group.
BLOCK = 1024
#: Pairs whose vectors are held at a time.
PAIRS = 1 << 15

SIGNED = "cid bigint, copies bigint, vector binary, keys array<bigint>"
FOUND = "u bigint, v bigint, links bigint"


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that one cell is shared at a Euclidean distance."""
    t = width / distance
    tail = 0.5 * math.erfc(t / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def plan(count: int, cosine: float) -> tuple[int, int]:
    """Cells in a key, and tables, for a number of distinct vectors."""
    unrelated, alike = collision(math.sqrt(2)), collision(math.sqrt(2 - 2 * cosine))
    k = max(8, math.ceil(math.log(20 * max(count, 1)) / -math.log(unrelated)))
    return k, math.ceil(math.log(1 - RECALL) / math.log(1 - alike**k))


def _matrix(payloads: list[bytes]) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones are padded, they never share a bucket."""
    vectors = [np.frombuffer(p, np.float64) for p in payloads]
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _sign(k: int, tables: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = {}
        for batch in batches:
            vectors = [np.array(v, np.float64) for v in batch["vector"].to_pylist()]
            # Any scale: the largest component is 1 before squares are summed.
            vectors = [v / np.abs(v).max() for v in vectors]
            vectors = [v / math.sqrt(v @ v) for v in vectors]
            keys = [None] * len(vectors)
            for size in {len(v) for v in vectors}:
                if size not in made:
                    rng = np.random.default_rng(size)
                    made[size] = rng.normal(size=(size, tables * k)), rng.uniform(
                        0, WIDTH, tables * k
                    )
                a, b = made[size]
                rows = [i for i, v in enumerate(vectors) if len(v) == size]
                for at in range(0, len(rows), 256):
                    some = rows[at : at + 256]
                    cells = np.floor((np.stack([vectors[i] for i in some]) @ a + b) / WIDTH)
                    cells = cells.astype(np.int64).view(np.uint64).reshape(len(some), tables, k)
                    h = np.full((len(some), tables), size, np.uint64)
                    for j in range(k):
                        h = h * np.uint64(BASE_A) + finish(cells[:, :, j] + np.uint64(j))
                    h = finish(h).view(np.int64)
                    for i, row in zip(some, h):
                        keys[i] = row
            yield pa.RecordBatch.from_arrays(
                [
                    batch["cid"],
                    batch["copies"],
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["cid", "copies", "vector", "keys"],
            )

    return sign


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches sorted by group."""
    group = ["table", "key", "x", "y"]
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        n = len(rows)
        if not n:
            continue
        last = np.ones(n, bool)
        for c in group:
            values = rows[c].to_numpy()
            last &= values == values[-1]
        cut = n - int(np.argmin(last[::-1])) if not last.all() else 0
        if cut:
            yield rows.slice(0, cut)
        held = rows.slice(cut)
    if held is not None and len(held):
        yield held


def _link(cosine: float):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            n = len(rows)
            at = [rows[c].to_numpy() for c in ("table", "key", "x", "y")]
            new = np.ones(n, bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in at], axis=0)
            start = np.flatnonzero(new)
            end = np.append(start[1:], n)[np.cumsum(new) - 1]
            table, same = at[0], at[2] == at[3]
            own, cid, copies = (rows[c].to_numpy() for c in ("own", "cid", "copies"))
            prints = np.frombuffer(b"".join(rows["prints"].to_pylist()), np.uint32).reshape(n, -1)
            vectors = _matrix(rows["vector"].to_pylist())
            left = end - np.arange(n) - 1  # partners after each row
            sums = np.concatenate(([0], np.cumsum(left)))
            links, label, pairs = np.zeros(n, np.int64), np.arange(n), []
            done = 0
            while done < n:
                to = max(done + 1, int(np.searchsorted(sums, sums[done] + PAIRS, side="right")) - 1)
                r = np.repeat(np.arange(done, to), left[done:to])
                s = r + 1 + np.arange(len(r)) - np.repeat(sums[done:to] - sums[done], left[done:to])
                done = to
                fit = same[r] | (own[r] != own[s])
                r, s = r[fit], s[fit]
                if not len(r):
                    continue
                cos = np.einsum("ij,ij->i", vectors[r], vectors[s])
                fit = cos >= cosine
                r, s = r[fit], s[fit]
                # Judged in the first table that the pair shares.
                fit = np.argmax(prints[r] == prints[s], 1) == table[r]
                r, s = r[fit], s[fit]
                np.add.at(links, r, copies[s])
                np.add.at(links, s, copies[r])
                pairs.append((r, s))
            if pairs:
                r, s = (np.concatenate(x) for x in zip(*pairs))
                order = np.argsort(cid, kind="stable")
                rank = np.empty(n, np.int64)
                rank[order] = np.arange(n)
                label = rank.copy()
                while True:  # smallest rank reachable within the groups
                    low = np.minimum(label[r], label[s])
                    before = label.copy()
                    np.minimum.at(label, r, low)
                    np.minimum.at(label, s, low)
                    if (label == before).all():
                        break
                hit = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cid[hit], pa.int64()),
                        pa.array(cid[order][label[hit]], pa.int64()),
                        pa.array(links[hit], pa.int64()),
                    ],
                    ["u", "v", "links"],
                )

    return link


def near_duplicates(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row (vec_id, embedding)."""
    fits = F.col("embedding").isNotNull() & F.forall(
        "embedding",
        lambda x: F.coalesce(~F.isnan(x.cast(DoubleType())) & (F.abs(x) < float("inf")), F.lit(False)),
    )
    fits &= F.coalesce(F.exists("embedding", lambda x: F.coalesce(x != 0, F.lit(False))), F.lit(False))
    rows = vectors.select(
        F.col("vec_id").cast("bigint"), F.when(fits, F.col("embedding")).alias("vector")
    )
    # Two hashes of the whole vector stand for it.
    print_ = [F.xxhash64("vector", F.lit(i)).alias(f"p{i}") for i in (1, 2)]
    rows = rows.withColumn("named", F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    rows = rows.select("vec_id", "named", "vector", *print_)
    classes = (
        rows.where("named")
        .groupBy("p1", "p2", "vec_id")
        .agg(F.first("vector").alias("vector"))
        .groupBy("p1", "p2")
        .agg(F.min("vec_id").alias("cid"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    )
    classes = stored(classes, "classes")
    k, tables = plan(classes.count(), cosine)
    signed = classes.select("cid", "copies", "vector").mapInArrow(_sign(k, tables), SIGNED)
    signed = stored(signed, "signed")

    cells = signed.select("cid", F.posexplode("keys").alias("table", "key"))
    shared = cells.groupBy("table", "key").count().where("count > 1")
    shared = shared.select("table", "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    met = cells.join(shared, ["table", "key"])
    met = met.withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")})
    # 32 bits of each key tell whether an earlier table is shared.
    prints = F.unhex(
        F.array_join(
            F.transform("keys", lambda h: F.lpad(F.hex(h.bitwiseAND(0xFFFFFFFF)), 8, "0")), ""
        )
    )
    payload = signed.select("cid", "copies", "vector", prints.alias("prints"))
    met = met.select("table", "key", "x", "y", "own", "cid").join(payload, "cid")
    group = ["table", "key", "x", "y"]
    met = met.repartition(*group).sortWithinPartitions(*group)
    met = met.select(*group, "own", "cid", "copies", "vector", "prints")
    found = stored(met.mapInArrow(_link(cosine), FOUND), "found")

    counts = found.groupBy(F.col("u").alias("cid")).agg(F.sum("links").alias("links"))
    labels = components(found.select("u", "v"))
    result = classes.select("p1", "p2", "cid", "copies").join(counts, "cid", "left")
    result = result.join(labels, F.col("cid") == F.col("node"), "left").select(
        "p1",
        "p2",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "cid").alias("component_id"),
        F.lit(True).alias("known"),
    )
    out = rows.select("vec_id", "named", "p1", "p2").join(result, ["p1", "p2"], "left")
    named = F.col("named") & F.col("known")
    component = F.coalesce(F.when(named, F.col("component_id")), F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce(F.when(named, F.col("n_links")), F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
