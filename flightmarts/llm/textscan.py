"""Word scanning over a flat UTF-8 buffer with numpy: no per-word Python work."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so invertible mod 2**64
_STEP = np.uint64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Lookup table: True outside the given inclusive byte ranges."""
    lut = np.ones(256, dtype=bool)
    for lo, hi in ranges:
        lut[lo : hi + 1] = False
    return lut


# words are runs of anything but ASCII white space
NOT_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
# words are runs of ASCII letters, digits and everything beyond ASCII
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def series(base: int) -> np.ndarray:
        out = np.full(n, np.uint64(base), dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out)

    return series(_BASE), series(pow(_BASE, -1, 1 << 64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(21, int(n).bit_length()))  # one table for all usual blocks


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with hash(data[s:e]) = (H[e] - H[s]) * inverse**s mod 2**64."""
    return prefix_codes(data)


def prefix_codes(codes: np.ndarray) -> np.ndarray:
    """The same over any array of symbol numbers."""
    up, _ = powers(len(codes) + 1)
    out = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=out[1:])
    return out


def substring_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


class Words:
    """Words of a block of texts: byte ``start``/``end``, 64-bit ``hash``, and
    ``first``: index of each text's first word (one more entry at the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        self.data = LOWER[data]
        inside = is_word[self.data]
        n = len(inside)
        after = np.zeros(n + 1, dtype=bool)  # a word may continue from the byte before
        after[1:n] = inside[: n - 1]
        after[offsets] = False
        self.start = np.flatnonzero(inside & ~after[:n])
        before = np.zeros(n + 1, dtype=bool)
        before[:n] = inside
        before[offsets] = False
        self.end = np.flatnonzero(inside & ~before[1:]) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.hash = substring_hash(prefix_hash(self.data), self.start, self.end)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the k words from each position, whether they lie in one text)."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        out = np.zeros(n - k + 1, dtype=np.uint64)
        for j in range(k):
            out = out * _STEP + self.hash[j : n - k + 1 + j]
        doc_end = np.repeat(self.first[1:], self.count)[: n - k + 1]
        return mix(out), np.arange(n - k + 1) + k <= doc_end

    def text(self, at: int, k: int) -> bytes:
        """The k lower-cased words from a position, joined by a space."""
        return b" ".join(self.data[self.start[i] : self.end[i]].tobytes() for i in range(at, at + k))
