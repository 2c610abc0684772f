"""Word splitting and 64-bit hashing shared by the operators that work on word sequences.

Words are maximal runs of characters other than the space and U+0009 to U+000D.  On UTF-8 bytes
that is what ``bytes.split()`` returns.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd multipliers of the rolling hashes; sums wrap at 64 bits.
BASE_A = 0x9E3779B97F4A7C15
BASE_B = 0xC2B2AE3D27D4EB4F
MASK = (1 << 64) - 1


class WordHashes(dict):
    """Word to 64-bit hash, remembering words already seen up to a bound."""

    LIMIT = 1 << 18

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = self.hash(word)
        return value

    def hash(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word)

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    """Words of a whole text; none for NULL."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def finish(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    if n:
        out[0] = 1
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


def rolling(tokens: np.ndarray, width: int, base: int = BASE_A) -> np.ndarray:
    """Rabin-Karp hash of every ``width`` consecutive tokens, modulo 2**64.

    The prefix sums hold ``token[i] * base**-i``; a difference of two of them, brought to a common
    power, is the polynomial of the window.
    """
    n = len(tokens) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    inverse = pow(base, -1, 1 << 64)
    sums = np.empty(len(tokens) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(tokens * _powers(inverse, len(tokens)), out=sums[1:])
    return finish((sums[width:] - sums[:-width]) * _powers(base, n))


def pack(sorted_hashes: np.ndarray) -> bytes:
    """Sorted 64-bit values by byte planes: the leading bytes repeat and compress away."""
    return sorted_hashes.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(payload: bytes) -> np.ndarray:
    planes = np.frombuffer(payload, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(">u8").ravel().astype(np.uint64)
