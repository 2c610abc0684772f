"""The operators on suffix arrays, term owners and token pointers, against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymarks.llm import suffixes
from waymarks.llm.divergence import source_divergence
from waymarks.llm.repeats import remove_repeated_bytes
from waymarks.llm.search import rank_documents

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "alpha beta Gamma delta épée zeta eta theta x1 7 straße naïve a-b 日本 word".split()


def lower(b: bytes) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in b)


def fixture(n: int, seed: int = 1):
    rng = random.Random(seed)

    def words(k):
        return " ".join(rng.choice(WORDS) for _ in range(k))

    shared = [words(12), "=" * 90, words(5)]
    rows = []
    for i in range(n):
        parts = [words(rng.randint(0, 30)) for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.5:
            parts.insert(rng.randint(0, len(parts)), rng.choice(shared))
        rows.append((i, rng.choice(". \n") .join(parts), rng.choice(["en", "de"]), f"s{rng.randint(0, 3)}", 0))
    rows += [
        (n, None, "en", None, None),
        (n + 1, "", None, "s1", 0),
        (n + 2, "a" * 20_000 + words(3000), "en", "s0", None),
        (None, words(20), "en", "s1", 1),
        (None, words(20), None, None, 1),
        (n + 3, rows[3][1], "en", "s2", 1),
        rows[4],
        rows[4],
        (n + 4, "\x00.,;", "xx", "only", 1),
    ]
    return rows


@pytest.fixture(scope="module")
def rows():
    return fixture(150)


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    # Columns that clash with names used inside.
    names = ["chunk", "bucket", "rank", "item", "shard", "term", "key", "part", "value", "total"]
    return df.withColumns({c: F.lit("x") for c in names})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_suffix_arrays_and_common_prefixes(monkeypatch):
    rng = random.Random(5)
    for alphabet in (0, 2, 2048):
        monkeypatch.setattr(suffixes, "ALPHABET", alphabet)
        for _ in range(300):
            k = rng.choice([1, 2, 3, 6])
            body = [rng.randint(1, k) for _ in range(rng.randint(0, 40))] * rng.choice([1, 1, 3])
            text = [*body, 0]
            order = suffixes.suffix_array(np.array(text), k + 1)
            want = sorted(range(len(text)), key=lambda i: text[i:])
            assert order.tolist() == want
            before, common = suffixes.permuted_prefixes(np.array(text), order)
            for x, y in zip(want[:-1], want[1:]):
                m = 0
                while text[x + m] == text[y + m]:
                    m += 1
                assert (before[y], common[y]) == (x, m)


def without_repeats(rows, width):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for r, t in zip(rows, texts):
        gone = [False] * len(t)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        edges = [i for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1])]
        ends = [i + 1 for i in range(len(t)) if gone[i] and (i + 1 == len(t) or not gone[i + 1])]
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((r[0], len(t), sum(gone), tuple(zip(edges, ends)), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize(
    "width, chunk, bucket, shard, split",
    [(60, 4_000_000, 12_000_000, 1_500_000, 4000), (60, 4000, 9000, 500, 1000), (12, 3000, 9000, 700, 3),
     (100, 5000, 9000, 2000, 1)],
)
def test_repeated_bytes(docs, rows, width, chunk, bucket, shard, split):
    got = remove_repeated_bytes(docs, width, chunk, bucket, shard, split).collect()
    plain = [
        (r.doc_id, r.n_bytes, r.n_removed, tuple((s.start, s.end) for s in r.removed), bytes(r.kept))
        for r in got
    ]
    assert all(len(r.removed) == r.n_spans for r in got)
    assert sorted(plain, key=repr) == without_repeats(rows, width)


def terms(text, pattern):
    return [lower(t) for t in re.findall(pattern, (text or "").encode())]


def ranked(rows, items, top):
    pattern = rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    docs = [(r[0], Counter(terms(r[1], pattern))) for r in rows]
    n_docs = sum(1 for _, c in docs if c)
    n_terms = sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for doc, c in docs:
            m = 25 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text, pattern)
                if t in c
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        scores.sort(key=lambda s: s[:3])
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(scores[:top])]
    return sorted(out, key=repr)


ITEMS = [
    (1, "alpha beta Épée 日本 7"),
    (2, "THETA theta zeta x1 nowhere"),
    (2, "another text of the item: eta"),
    (3, None),
    (4, ""),
    (5, "nothing known"),
    (None, "straße, naïve"),
    (1, "alpha beta Épée 日本 7"),
    (6, " ".join(WORDS) * 50),
]


@pytest.mark.parametrize(
    "top, stages, bundle, shard", [(10, (0.001, 0.01, 0.1), 64, 4096), (3, (0.2, 0.3, 0.4), 2, 16), (1, (), 1, 7)]
)
def test_ranked_documents(spark, docs, rows, top, stages, bundle, shard):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    items = items.withColumns({c: F.lit(1) for c in ("item", "term", "stage", "doc_id")})
    got = rank_documents(docs, items, top, stages, bundle, shard).collect()
    assert sorted([tuple(r) for r in got], key=repr) == ranked(rows, ITEMS, top)


def diverged(rows, least_docs, top):
    pattern = rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
    groups = sorted({(r[2] or "", r[3] or "") for r in rows})
    df, counts = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        own = terms(r[1], pattern)
        df[r[2] or ""].update(set(own))
        counts[r[2] or "", r[3] or ""].update(own)
    out = []
    for lang in sorted({g[0] for g in groups}):
        kept = [t for t, n in df[lang].items() if n >= least_docs]
        own = [s for g, s in groups if g == lang]

        def share(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        p = {s: share(counts[lang, s]) for s in own}
        q = share(sum((counts[lang, s] for s in own), Counter()))
        for s in own:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s)
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, o) in enumerate(pairs)]
            more = sorted(
                (q[t] - p[s][t], t) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]
            )
            out += [(lang, s, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(more[:top])]
    return sorted(out)


@pytest.mark.parametrize("least, top, bucket", [(5, 50, 16_000_000), (1, 3, 2000), (10**6, 5, 2000)])
def test_divergence(docs, rows, least, top, bucket):
    got = source_divergence(docs, least, top=top, bucket_bytes=bucket)
    assert sorted(tuple(r) for r in got.collect()) == diverged(rows, least, top)


def test_long_terms_are_sorted_whole(spark):
    long = "a" * 3000
    texts = [f"{long}b {long}c {long}", f"{long}c", f"{long} {long}b {long}{long}"]
    rows = [(i, t, "en", f"s{i}", 0) for i, t in enumerate(texts)]
    got = source_divergence(spark.createDataFrame(rows, SCHEMA), 1)
    assert sorted(tuple(r) for r in got.collect()) == diverged(rows, 1, 50)


def test_empty_tables(spark, docs, empty):
    assert remove_repeated_bytes(empty).count() == 0
    assert source_divergence(empty).count() == 0
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert rank_documents(empty, items).count() == 0
    assert rank_documents(docs, items.limit(0)).count() == 0


def test_kept_bytes_are_whole(docs, rows):
    kept = remove_repeated_bytes(docs, 10_000).where("doc_id = 0").first()
    assert hashlib.sha256(bytes(kept.kept)).digest() == hashlib.sha256(rows[0][1].encode()).digest()
