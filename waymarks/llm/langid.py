"""Language identification: averaged hashed subword embeddings and a linear softmax.

Every character n-gram of a text (n = 1 to 4, letters in lower case, other characters as breaks)
hashes to a row of an embedding table; the mean row meets a linear softmax over the languages.  Both
are trained together by stochastic gradient descent in numpy on a bounded sample of labelled rows.
Since the layers are linear, table times weights gives one score vector per row, and predicting is a
lookup and a mean over the whole text.

The sample takes about ``per_language`` rows of each language, and fewer of each where there are so many
languages that this would be more than ``most_rows``; rows are chosen by a hash of id and text, and equal
rows count once.  A fifth of it is not trained on: it calibrates a temperature and two bounds, each
passed by all but ``reject_rate`` of labelled rows: the score of a prediction, and its familiarity, the
share of the text's letter pairs that the training texts have.  A prediction below either is rejected,
so that text of an unlearned script, and letters that form no words, are.

Defined results: NULL text, and text without a letter, is ``und`` with score 0, and rejected.  Text of
letters always gets a learned language, rejected or not.  Without labelled rows everything is ``und``.  An empty table
gives an empty result.  Repeated rows are rows of their own.  Other columns are never inputs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
GRAMS = (1, 2, 3, 4)
BITS = 16
DIMENSION = 16
#: Sampled rows over all languages, about.
MOST_ROWS = 50_000
#: What a calibrated bound is multiplied by, so that text a little odder than the sample passes.
SLACK = 0.9
#: Texts are hashed in runs of so many characters, whatever their length.
RUN = 1 << 20

PREDICTED = "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean"

_LETTER = re.compile(r"[^\W\d_]")
_BREAK = re.compile(r"[\W\d_]+")


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


def grams(text: str, sizes: tuple[int, ...] = GRAMS) -> np.ndarray:
    """Rows of the embedding table for every n-gram of a whole text."""
    plain = f" {_BREAK.sub(' ', text.lower()).strip()} "
    codes = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = []
    for n in sizes:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, 0x811C9DC5 + n, np.uint32)
        for i in range(n):
            h = (h ^ codes[i : len(codes) - n + 1 + i]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        out.append(h >> np.uint32(32 - BITS))
    return np.concatenate(out)


def _pieces(text: str, sizes: tuple[int, ...] = GRAMS) -> Iterator[np.ndarray]:
    for at in range(0, len(text), RUN):
        yield grams(text[at : at + RUN], sizes)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # one row of language scores for each row of the embedding table
    temperature: float = 1.0
    threshold: float = 0.0
    pairs: np.ndarray | None = None  # whether training texts have a letter pair, by its row
    least_familiar: float = 0.0

    def familiarity(self, text: str) -> float:
        """Share of the letter pairs of a whole text that training texts have."""
        known = total = 0
        for rows in _pieces(text, (2,)):
            known += int(self.pairs[rows].sum())
            total += len(rows)
        return known / max(total, 1)

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for rows in _pieces(text):
            total += self.scores[rows].sum(0)
            n += len(rows)
        return total / max(n, 1)

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)


def _sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    counts = np.zeros(1 << BITS, np.int64)
    for rows in _pieces(text):
        counts += np.bincount(rows, minlength=1 << BITS)
    rows = np.flatnonzero(counts)
    return rows, (counts[rows] / counts[rows].sum()).astype(np.float32)


def train(
    texts: list[str], labels: list[str], epochs: int = 10, rate: float = 1.0, seed: int = 13
) -> Model:
    """Stochastic gradient descent over documents; every fifth one calibrates."""
    languages = sorted(set(labels))
    index = {name: i for i, name in enumerate(languages)}
    y = np.array([index[x] for x in labels])
    data = [_sparse(t) for t in texts]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    check, fit = order[::5], [i for k, i in enumerate(order) if k % 5]
    fit = np.array(fit or order, np.int64)
    table = rng.normal(0, 0.1, (1 << BITS, DIMENSION)).astype(np.float32)
    weights = rng.normal(0, 0.1, (DIMENSION, len(languages))).astype(np.float32)
    steps, total = 0, epochs * len(fit)
    for _ in range(epochs):
        for i in rng.permutation(fit):
            rows, share = data[i]
            mean = share @ table[rows]
            z = mean @ weights
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1.0
            step = rate * (1 - steps / total)
            back = weights @ p
            weights -= (step / 4) * np.outer(mean, p)
            # A document's rows share its gradient by their frequency; 50 makes up for the mean.
            table[rows] -= (50 * step) * np.outer(share, back)
            steps += 1
    model = Model(languages, (table @ weights).astype(np.float32))
    model.pairs = np.zeros(1 << BITS, bool)
    for i in fit:
        for rows in _pieces(texts[i], (2,)):
            model.pairs[rows] = True
    check = [int(i) for i in check]
    familiar = np.array([model.familiarity(texts[i]) for i in check])
    return calibrate(model, [data[i] for i in check], y[check], familiar)


def calibrate(
    model: Model, data: list, y: np.ndarray, familiar: np.ndarray, reject_rate: float = 0.001
) -> Model:
    """Temperature of the least log loss, then the bounds that 1 - reject_rate pass."""
    if not len(y):
        return model
    logits = np.stack([share @ model.scores[rows] for rows, share in data])
    best = np.inf
    for t in np.geomspace(0.5, 20, 40):
        model_t = Model(model.languages, model.scores, float(t))
        p = model_t.probabilities(logits)[np.arange(len(y)), y]
        loss = -np.log(np.maximum(p, 1e-12)).mean()
        if loss < best:
            best, model.temperature = loss, float(t)
    top = model.probabilities(logits).max(1)
    # Never asking less than chance.
    floor = 1.0 / len(model.languages)
    model.threshold = float(max(np.quantile(top, reject_rate) * SLACK, floor))
    model.least_familiar = float(np.quantile(familiar, reject_rate) * SLACK)
    return model


def sample(
    docs: DataFrame, per_language: int, learnable: Column, most_rows: int = MOST_ROWS
) -> tuple[list[str], list[str]]:
    """A bounded, repeatable sample of labelled rows, about as many of each language."""
    rows = docs.where(learnable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return [], []
    per_language = min(per_language, max(1, most_rows // len(sizes)))
    share = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, per_language / n)))
    at = F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.where(at < share[F.col("lang")]).select("doc_id", "text", "lang")
    got = chosen.distinct().collect()
    got.sort(key=lambda r: (r.lang, r.doc_id is None, r.doc_id or 0, r.text))
    got = [r for r in got if has_letter(r.text)]
    return [r.text for r in got], [r.lang for r in got]


def judge(model: Model | None, text: str | None) -> tuple[str, float, bool]:
    """Language, calibrated score, and whether the prediction is rejected."""
    if model is None or not has_letter(text):
        return UNKNOWN, 0.0, True
    p = model.probabilities(model.logits(text))
    best = int(np.argmax(p))
    rejected = p[best] < model.threshold or model.familiarity(text) < model.least_familiar
    return model.languages[best], float(p[best]), bool(rejected)


def predict(docs: DataFrame, model: Model | None, held: Column) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(shared.value, text.as_py()) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["held_out"],
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                    pa.array([x[2] for x in found], pa.bool_()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text", held.alias("held_out"))
    return rows.select("doc_id", "held_out", "text").mapInArrow(run, PREDICTED)


def held_out(remainder: int = 2, modulus: int = 4) -> Column:
    """Rows never learned from; a NULL id counts as the empty string."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text) % modulus == remainder


def identify(
    docs: DataFrame, held: Column | None = None, per_language: int = 1000
) -> DataFrame:
    """doc_id, held_out, lang_pred, score (calibrated) and rejected of every row."""
    held = held_out() if held is None else held
    texts, labels = sample(docs, per_language, ~held)
    return predict(docs, train(texts, labels) if texts else None, held)


def keep_identified(docs: DataFrame, per_language: int = 1000) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose prediction is not rejected."""
    texts, labels = sample(docs, per_language, ~held_out())
    shared = docs.sparkSession.sparkContext.broadcast(train(texts, labels) if texts else None)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [not judge(shared.value, text.as_py())[2] for text in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
