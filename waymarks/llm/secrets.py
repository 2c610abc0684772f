"""Secret scan: fixed patterns, and strings that a tokenizer's vocabulary cannot compress.

Base kinds are found by pattern in the whole text: ``assign`` (a password-like name, a sign and a value
of 6 or more characters), ``access`` (AKIA and more, 20 or more characters) and ``hex`` (24 or more
lowercase hexadecimal digits), each leftmost and without overlaps of its kind.

``random`` spans come from the token-efficiency test: runs of 16 or more characters of keys and
encodings, or what base spans leave of them, are encoded with a tiktoken vocabulary.  If a run is not
random as a whole, its pieces between ``/ - _ = +`` of 16 or more characters are tested each.  Text
that people write gets 3 to 5 characters a token; a random string gets less than 2, and letters
without digits, of one case or with one change of case, must get less than 1.9.  Known digests
(hexadecimal of the usual digest lengths) and known identifiers (UUIDs, numbers, dates, versions) are
not flagged, neither is what a base span covers.

Defined results: NULL text is empty.  Spans are in code points, end exclusive, start with the
smallest start, ties in the order assign, access, hex, random.  Repeated rows are scanned each.  An
empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters a token below which a run counts as random.
MOST_CHARS_A_TOKEN = 2.0
#: The same for letters alone, of one case or with one change of case, which are words more often.
MOST_CHARS_LETTERS = 1.9
#: Vocabulary file that every machine has; a parameter of ``scan`` and ``redact``.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# The base patterns, their least lengths, and the order of kinds.
ASSIGN = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
LEAST_ACCESS = 20
LEAST_RUN = 16
#: Different letters of a random string; fewer are rulers and repeated syllables.
LEAST_LETTERS = 6
KINDS = ("assign", "access", "hex", "random")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

_ASSIGN = re.compile(ASSIGN)
_ACCESS = re.compile(ACCESS)
# Runs of 24 and more are what the pattern of any length leaves after dropping shorter matches.
_HEX = re.compile(HEX)
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_PIECE = re.compile(r"[A-Za-z0-9]{16,}")
_LETTERS = re.compile(r"[A-Za-z]+")
_DIGEST = re.compile(
    r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}"
    r"|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{56}|[0-9A-F]{64}|[0-9A-F]{96}|[0-9A-F]{128})"
)
_IDENTIFIER = re.compile(
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|[vV]?[0-9_/=+-]+(?:[TZ][0-9-]*)*"
)
_MIXED = re.compile(r"[0-9].*[A-Za-z]|[A-Za-z].*[0-9]|[a-z].*[A-Z].*[a-z].*[A-Z]")

FOUND = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>"
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

#: The split pattern of the vocabulary files, a fixed value of the format.
SPLIT = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds."""
    out = []
    low = text.lower()
    # The names are ASCII; other characters that lower-case to ASCII only cost a scan.
    if any(name in low for name in NAMES):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_VALUE:
                out.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                out.append((m.start(), 1, m.end()))
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _is_random(run: str, encoding, most: float) -> bool:
    """Whether a run gets few characters a token; letters like those of a word by a stricter ratio."""
    if _DIGEST.fullmatch(run) or _IDENTIFIER.fullmatch(run):
        return False
    if not _MIXED.search(run):
        if not _LETTERS.fullmatch(run) or len(set(run)) < LEAST_LETTERS:
            return False
        most = min(most, MOST_CHARS_LETTERS)
    # Long runs are judged by parts, so the encoder's work stays in proportion.
    tokens = sum(
        len(encoding.encode_ordinary(run[i : i + 4096])) for i in range(0, len(run), 4096)
    )
    return len(run) < most * tokens


def _outside(start: int, end: int, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What sorted base spans leave of a run."""
    for s, _, e in base:
        if s < end and start < e:
            if start < s:
                yield start, s
            start = max(start, e)
    if start < end:
        yield start, end


def random_spans(
    text: str, base: list[tuple[int, int, int]], encoding, most: float = MOST_CHARS_A_TOKEN
) -> list[tuple[int, int, int]]:
    """Spans of runs, or of their pieces, with few characters a token, outside the base spans."""
    out = []
    for m in _RUN.finditer(text):
        if _DIGEST.fullmatch(m[0]) or _IDENTIFIER.fullmatch(m[0]):
            continue
        for start, end in _outside(*m.span(), base):
            if end - start < LEAST_RUN:
                continue
            if _is_random(text[start:end], encoding, most):
                out.append((start, 3, end))
                continue
            for piece in _PIECE.finditer(text, start, end):
                if piece.span() != (start, end) and _is_random(piece[0], encoding, most):
                    out.append((piece.start(), 3, piece.end()))
    return out


def scan(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and ``spans`` (kind, start, end) of every row, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary)
        for batch in batches:
            spans = []
            for text in batch["text"]:
                text = text.as_py() or ""
                base = base_spans(text)
                found = sorted(base + random_spans(text, base, encoding))
                spans.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in found])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(spans, SPANS)], ["doc_id", "spans"]
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, FOUND)


def redact(docs: DataFrame, mark: str = "[secret]", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``; overlapping spans become one."""
    schema = docs.schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary)
        for batch in batches:
            texts = []
            for text in batch.column(at):
                text = text.as_py()
                if text:
                    base = base_spans(text)
                    parts, done = [], 0
                    for start, _, end in sorted(base + random_spans(text, base, encoding)):
                        if start >= done:
                            parts += [text[done:start], mark]
                        done = max(done, end)
                    text = "".join(parts) + text[done:]
                texts.append(text)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, schema)
