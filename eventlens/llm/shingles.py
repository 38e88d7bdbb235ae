"""Word shingles and MinHash signatures, vectorised for Arrow batches."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
SYMBOLS = 64

_RNG = np.random.Generator(np.random.PCG64(20))
#: Odd multipliers and offsets of the signature's hash functions, and of the
#: words of a shingle; any fixed draw will do.
_A = _RNG.integers(1, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, SYMBOLS, dtype=np.uint64)
_C = _RNG.integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Words whose hash a worker remembers.
_REMEMBERED = 200_000


class WordHashes(dict):
    """Word -> 64-bit hash, of a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles of a UTF-8 text;
    of a text of fewer words, that of the whole sequence.  ``bytes.lower`` and
    ``bytes.split`` know exactly A-Z and the six ASCII white spaces."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.array(list(map(hashes.__getitem__, words)), dtype=np.uint64)
    n = len(h) - WORDS + 1
    if n < 1:
        return mixed(np.array([(h * _C[: len(h)]).sum() + np.uint64(len(h))], np.uint64))
    out = h[:n] * _C[0]
    for j in range(1, WORDS):
        out += h[j : j + n] * _C[j]
    return np.unique(mixed(out))


def signature(shingles: np.ndarray) -> np.ndarray:
    """SYMBOLS 16-bit symbols: the scrambled minimum of each hash function."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 4096):
        block = shingles[i : i + 4096, None] * _A + _B
        np.minimum(least, block.min(axis=0), out=least)
    return (mixed(least) >> np.uint64(48)).astype(np.uint16)
