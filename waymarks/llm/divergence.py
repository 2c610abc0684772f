"""How the sources of a language differ in their words, from a token-start pointer sort.

Shards of documents are read as Arrow text buffers.  In a shard the pointers to the starts of terms are
sorted by the terms they point to; documents stand in order of language and source before, so an
equal run of the sort has its occurrences by source and document, and gives the term's document frequency
and its count in each source.  A shard sends each distinct term of a language once, to the bucket of
the term's hash, however common it is.  Buckets sort the terms of all shards again and keep those in
enough documents.  Blocks of kept terms then give partial sums of the distances between sources and
their leading terms, which Spark sums and ranks.

Defined results: NULL text, lang and source are ''.  Repeated rows are documents of their own; doc_id
and other columns are not read.  A group without kept terms has pairs but no terms; pairs of a
language without kept terms have the value 0.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymarks.llm.chunks import parts, text_bytes
from waymarks.llm.stored import stored
from waymarks.llm.terms import Terms, byte_table, ranges, shards, sort_pointers

#: Documents of a language that a term needs, the constant added to counts, and the unit of shares.
LEAST_DOCS = 30
ADDED = 5
UNIT = 1_000_000_000
TOP = 50
#: Text bytes whose terms one bucket receives, about.
BUCKET_BYTES = 16_000_000
#: Entries of a matrix of terms by sources in memory at once.
CELLS = 1_000_000

SENT = (
    "lang string, bucket int, terms binary, docs binary, n_sources binary, source binary, "
    "count binary, sources array<string>"
)
KEPT = (
    "lang string, n_terms bigint, terms binary, term binary, source binary, count binary, "
    "sources array<string>, totals array<bigint>"
)
SCORED = "lang string, source string, part string, item string, value bigint"


def _codes(column: pa.ChunkedArray) -> tuple[list[str], np.ndarray]:
    coded = pc.dictionary_encode(pa.concat_arrays(column.chunks))
    return coded.dictionary.to_pylist(), coded.indices.to_numpy()


def _send(buckets: int):
    table = byte_table(digits=False)

    def rows(lang: str, sources: list[str], source_of: np.ndarray, terms: Terms, a: int, b: int):
        order, new = sort_pointers(terms.data, terms.start[a:b], terms.length[a:b])
        doc = terms.doc[a:b][order]
        source = source_of[doc]
        term = np.cumsum(new) - 1
        new_doc, new_source = new.copy(), new.copy()
        new_doc[1:] |= doc[1:] != doc[:-1]
        new_source[1:] |= source[1:] != source[:-1]
        docs = np.bincount(term[new_doc])
        at = np.flatnonzero(new_source)
        count = np.diff(np.append(at, b - a))
        source = source[at]
        n_sources = np.bincount(term[at])
        first = np.cumsum(n_sources) - n_sources
        shown = order[new]
        s, e = terms.start[a:b][shown], (terms.start[a:b] + terms.length[a:b])[shown]
        raw = terms.data.tobytes()
        texts = [raw[i:j] for i, j in zip(s.tolist(), e.tolist())]
        digest = xxhash.xxh3_64_intdigest
        bucket = np.fromiter((digest(t) % buckets for t in texts), np.int32, len(texts))
        by = np.argsort(bucket, kind="stable")
        to, cut = np.unique(bucket[by], return_index=True)
        for owner, ids in zip(to.tolist(), np.split(by, cut[1:])):
            entry = ranges(first[ids], n_sources[ids])
            used, local = np.unique(source[entry], return_inverse=True)
            yield (
                lang,
                owner,
                b"\n".join([texts[i] for i in ids.tolist()]),
                docs[ids].astype(np.uint32).tobytes(),
                n_sources[ids].astype(np.uint32).tobytes(),
                local.astype(np.uint32).tobytes(),
                count[entry].astype(np.uint32).tobytes(),
                [sources[i] for i in used.tolist()],
            )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches):
            langs, lang = _codes(shard["lang"])
            sources, source = _codes(shard["source"])
            by = np.lexsort((source, lang))
            terms = Terms(shard["text"].take(pa.array(by)), table)
            lang, source = lang[by], source[by]
            cut = [0, *(np.flatnonzero(np.diff(lang)) + 1).tolist(), len(lang)]
            edges = np.searchsorted(terms.doc, cut).tolist()
            for first, a, b in zip(cut, edges[:-1], edges[1:]):
                if b > a:
                    sent = list(rows(langs[lang[first]], sources, source, terms, a, b))
                    yield _batch(sent, _SENT)

    return send


_SENT = pa.schema(
    [("lang", pa.string()), ("bucket", pa.int32())]
    + [(c, pa.binary()) for c in ("terms", "docs", "n_sources", "source", "count")]
    + [("sources", pa.list_(pa.string()))]
)
_KEPT = pa.schema(
    [("lang", pa.string()), ("n_terms", pa.int64())]
    + [(c, pa.binary()) for c in ("terms", "term", "source", "count")]
    + [("sources", pa.list_(pa.string())), ("totals", pa.list_(pa.int64()))]
)
_SCORED = pa.schema(
    [(c, pa.string()) for c in ("lang", "source", "part", "item")] + [("value", pa.int64())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _numbers(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in column.to_pylist()]).astype(np.int64)


def _keep(least_docs: int):
    def keep(sent: pa.Table) -> pa.Table:
        """Of one language and bucket: the terms in enough documents, with their counts by source."""
        data = np.frombuffer(b"\n".join(sent["terms"].to_pylist()), np.uint8)
        ends = np.append(np.flatnonzero(data == 10), len(data))
        start = np.concatenate([[0], ends[:-1] + 1])
        order, new = sort_pointers(data, start, ends - start)
        first = np.flatnonzero(new)
        docs = np.add.reduceat(_numbers(sent["docs"], np.uint32)[order], first)
        enough = docs >= least_docs
        if not enough.any():
            return _KEPT.empty_table()
        # New number of each sent term, -1 for those that go.
        number = np.where(enough, np.cumsum(enough) - 1, -1)
        term = np.empty(len(start), np.int64)
        term[order] = number[np.cumsum(new) - 1]
        known: dict[str, int] = {}
        local = [
            np.array([known.setdefault(s, len(known)) for s in names], np.int64)[
                np.frombuffer(at, np.uint32)
            ]
            for names, at in zip(sent["sources"].to_pylist(), sent["source"].to_pylist())
        ]
        source = np.concatenate(local)
        term = np.repeat(term, _numbers(sent["n_sources"], np.uint32))
        count = _numbers(sent["count"], np.uint32)
        stays = term >= 0
        cell = term[stays] * len(known) + source[stays]
        by = np.argsort(cell, kind="stable")
        cell, count = cell[by], count[stays][by]
        at = np.flatnonzero(np.diff(cell, prepend=-1))
        cell, count = cell[at], np.add.reduceat(count, at)
        term, source = cell // len(known), cell % len(known)
        totals = np.zeros(len(known), np.int64)
        np.add.at(totals, source, count)
        shown = order[first[enough]]
        raw = data.tobytes()
        texts = [raw[i:j] for i, j in zip(start[shown].tolist(), ends[shown].tolist())]
        row = (
            sent["lang"][0].as_py(),
            len(texts),
            b"\n".join(texts),
            term.astype(np.uint32).tobytes(),
            source.astype(np.uint32).tobytes(),
            count.tobytes(),
            list(known),
            totals.tolist(),
        )
        return pa.Table.from_batches([_batch([row], _KEPT)])

    return keep


def _share(count: np.ndarray, total: np.ndarray | int, added: int, unit: int) -> np.ndarray:
    """1 + floor(unit * (count + added) / total), digit by digit so that nothing overflows."""
    rest, out = np.asarray(count + added), 0
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    assert unit == 1000**3
    return 1 + out


def _score(added: int, top: int):
    def pairs_and_terms(row: dict) -> list[tuple]:
        groups = row["groups"]
        names = [g["source"] for g in groups]
        distance = np.zeros((len(names), len(names)), np.int64)
        out: list[tuple] = []
        n_terms = row["n_terms"] or 0
        if n_terms:
            at = {name: i for i, name in enumerate(names)}
            place = np.array([at[s] for s in row["sources"]], np.int64)
            term = np.frombuffer(row["term"], np.uint32).astype(np.int64)
            source = place[np.frombuffer(row["source"], np.uint32)]
            count = np.frombuffer(row["count"], np.int64)
            whole = row["kept_terms"] * added
            totals = np.array([g["total"] for g in groups], np.int64) + whole
            texts = row["terms"].split(b"\n")
            best: list[list[tuple[int, bytes]]] = [[] for _ in names]
            step = max(1, CELLS // len(names))
            for low in range(0, n_terms, step):
                a, b = np.searchsorted(term, [low, low + step])
                size = min(step, n_terms - low)
                counts = np.zeros((size, len(names)), np.int64)
                counts[term[a:b] - low, source[a:b]] = count[a:b]
                p = _share(counts, totals, added, UNIT)
                q = _share(counts.sum(1), row["lang_total"] + whole, added, UNIT)
                for i in range(len(names)):
                    distance[i] += np.abs(p - p[:, i : i + 1]).sum(0)
                    more = np.flatnonzero((counts[:, i] > 0) & (p[:, i] > q))
                    f = p[more, i] - q[more]
                    # Terms of a block stand in byte order, so a stable sort settles ties.
                    lead = np.argsort(-f, kind="stable")[:top]
                    best[i] += [(-int(f[j]), texts[low + more[j]]) for j in lead]
            for name, found in zip(names, best):
                out += [
                    (row["lang"], name, "term", t.decode("utf-8"), -f) for f, t in sorted(found)[:top]
                ]
        for i, name in enumerate(names):
            out += [
                (row["lang"], name, "pair", other, int(distance[i, j]))
                for j, other in enumerate(names)
                if i != j
            ]
        return out

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _batch(pairs_and_terms(row), _SCORED)

    return score


def source_divergence(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    added: int = ADDED,
    top: int = TOP,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Distances between the sources of each language, and the leading terms of each source.

    Returns lang, source, part, item, value, rank.  Part ``pair``: item is another source of the
    language, value the sum over kept terms of the difference of their shares.  Part ``term``: item is
    a term that the source uses more than its language, value by how much, the ``top`` first.
    """
    texts = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    )
    buckets = parts(text_bytes(docs), bucket_bytes)
    sent = texts.mapInArrow(_send(buckets), SENT)
    kept = sent.groupBy("lang", "bucket").applyInArrow(_keep(least_docs), KEPT)
    kept = stored(kept, "kept-terms")
    totals = (
        kept.select("lang", F.explode(F.arrays_zip("sources", "totals")).alias("g"))
        .groupBy("lang", F.col("g.sources").alias("source"))
        .agg(F.sum("g.totals").alias("total"))
    )
    groups = (
        texts.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .groupBy("lang")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total")))
            ).alias("groups"),
            F.coalesce(F.sum("total"), F.lit(0)).alias("lang_total"),
        )
    )
    sizes = kept.groupBy("lang").agg(F.sum("n_terms").alias("kept_terms"))
    blocks = groups.join(sizes, "lang", "left").join(kept.drop("totals"), "lang", "left")
    scored = blocks.mapInArrow(_score(added, top), SCORED)
    summed = scored.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = summed.withColumn("rank", F.row_number().over(best))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))
