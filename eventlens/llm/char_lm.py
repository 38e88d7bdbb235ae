"""Interpolated Kneser-Ney character models in sorted arrays.

A text is folded to letters (lower case) and single spaces, as UTF-16 units;
an n-gram of up to four units packs into 64 bits.  The model keeps, per order,
the sorted packed n-grams of all languages together and one row of
log-probabilities per n-gram, a column per language: a language that never saw
the n-gram has its backed-off probability there, so one binary search scores
all languages at once.  Where those rows would have more than ``CELLS`` numbers
every language is searched by itself, with the same results.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

ORDER = 4
SPACE = 32
#: Distinct folded units assumed for the uniform floor.
ALPHABET = 1 << 16
#: Log-probabilities kept for all languages at once (4 bytes each).
CELLS = 1 << 24


@lru_cache(1)
def folding() -> np.ndarray:
    """UTF-16 unit -> lower-case letter, or a space for anything else.
    Surrogate halves stand for the letters beyond the basic plane."""
    table = np.full(1 << 16, SPACE, np.uint16)
    for i in range(1 << 16):
        if 0xD800 <= i < 0xE000:
            table[i] = i
        elif chr(i).isalpha():
            low = chr(i).lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def folded(text: bytes | None) -> np.ndarray:
    """A UTF-8 text as folded units, with one space at each end and none doubled."""
    chars = (text or b"").decode("utf-8", "replace")
    units = np.frombuffer(chars.encode("utf-16-le"), np.uint16)
    if len(units) > len(chars):
        chars = "".join(c if c < "\U00010000" or c.isalpha() else " " for c in chars)
        units = np.frombuffer(chars.encode("utf-16-le"), np.uint16)
    out = np.concatenate([[SPACE], folding()[units], [SPACE]]).astype(np.uint64)
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != SPACE) | (out[:-1] != SPACE)
    return out[keep]


def packed(units: np.ndarray, n: int) -> np.ndarray:
    """All n-grams of a folded text, the oldest unit highest."""
    out = np.zeros(max(0, len(units) - n + 1), np.uint64)
    for j in range(n):
        out = (out << np.uint64(16)) | units[j : j + len(out)]
    return out


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys added up, sorted."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


class KneserNey:
    """One language's interpolated model, estimated from counts of ORDER-grams."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams: dict[int, np.ndarray] = {}
        self.logp: dict[int, np.ndarray] = {}
        self.contexts: dict[int, np.ndarray] = {}
        self.backoff: dict[int, np.ndarray] = {}
        tables = {ORDER: (grams, counts.astype(float))}
        for n in range(ORDER - 1, 0, -1):
            # the continuation count: how many different units come before
            longer = tables[n + 1][0] & np.uint64((1 << 16 * n) - 1)
            tables[n] = summed(longer, np.ones(len(longer)))
        lower = None
        for n in range(1, ORDER + 1):
            keys, c = tables[n]
            ones, twos = (c == 1).sum(), (c == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            context = keys >> np.uint64(16)
            heads, totals = summed(context, c)
            _, kinds = summed(context, np.ones(len(c)))
            at = np.searchsorted(heads, context)
            backoff = discount * kinds / totals
            below = np.full(len(keys), 1 / ALPHABET) if lower is None else lower(keys & np.uint64((1 << 16 * (n - 1)) - 1))
            p = (c - discount) / totals[at] + backoff[at] * below
            self.grams[n], self.logp[n] = keys, np.log2(p)
            self.contexts[n], self.backoff[n] = heads, np.log2(backoff)
            lower = lambda grams, n=n: np.exp2(self.score(grams, n))

    def score(self, grams: np.ndarray, n: int) -> np.ndarray:
        """log2 P(last unit | the n - 1 before), by interpolation."""
        if n == 0:
            return np.full(len(grams), -np.log2(ALPHABET))
        at, known = found(self.grams[n], grams)
        out = np.empty(len(grams))
        out[known] = self.logp[n][at[known]]
        rest = ~known
        if rest.any():
            shorter = self.score(grams[rest] & np.uint64((1 << 16 * (n - 1)) - 1), n - 1)
            where, seen = found(self.contexts[n], grams[rest] >> np.uint64(16))
            out[rest] = shorter + np.where(seen, self.backoff[n][where], 0.0)
        return out


def found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


class LanguageModels:
    """All languages' models merged into one sorted array of ORDER-grams."""

    def __init__(self, counted: dict[str, tuple[np.ndarray, np.ndarray]], cells: int = CELLS):
        self.languages = sorted(counted)
        self.models = [KneserNey(*counted[x]) for x in self.languages]
        self.grams = np.unique(np.concatenate([m.grams[ORDER] for m in self.models]))
        self.logp = self._scores(self.grams).astype(np.float32) if len(self.grams) * len(self.models) <= cells else None

    def _scores(self, grams: np.ndarray) -> np.ndarray:
        return np.stack([m.score(grams, ORDER) for m in self.models], axis=1)

    def entropies(self, units: np.ndarray) -> np.ndarray:
        """Cross-entropy in bits per unit of a folded text under every model."""
        keys, counts = np.unique(packed(padded(units), ORDER), return_counts=True)
        at, known = found(self.grams, keys)
        if self.logp is None:
            scores = self._scores(keys)
            scores[known] = scores[known].astype(np.float32)
        else:
            scores = self.logp[at].astype(float)
            if not known.all():
                scores[~known] = self._scores(keys[~known])
        return -(counts @ scores) / counts.sum()


def padded(units: np.ndarray) -> np.ndarray:
    """Leading spaces give the first letters a context."""
    return np.concatenate([np.full(ORDER - 2, SPACE, np.uint64), units])
