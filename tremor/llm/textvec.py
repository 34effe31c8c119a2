"""Vectorised words over the UTF-8 bytes of many texts at once.

A word is a maximal run of bytes of one class. Its 64-bit hash is a polynomial of random byte values, taken from one
running sum over the whole buffer and finished with a bit mixer, so no Python code runs per word.
"""

from __future__ import annotations

import numpy as np

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def byte_class(*spans: tuple[int, int], invert: bool = False) -> np.ndarray:
    out = np.zeros(256, bool)
    for lo, hi in spans:
        out[lo : hi + 1] = True
    return ~out if invert else out


#: Words separated by the six ASCII white spaces.
SPACED = byte_class((0x20, 0x20), (0x09, 0x0D), invert=True)
#: Words of ASCII letters and digits and of all that is not ASCII.
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F), invert=True)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finish 64-bit hashes so that every bit depends on every bit."""
    h = (h ^ (h >> np.uint64(30))) * M1
    h = (h ^ (h >> np.uint64(27))) * M2
    return h ^ (h >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse; the longest tables made so far are kept, shorter ones are parts of them."""
    if not _POWERS or len(_POWERS[0]) < n:
        made = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(max(n, 1 << 16), np.uint64(b))
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``buf[s:e]``; equal bytes have equal hashes wherever they stand."""
    up, down = _powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_VALUES[buf] * up[: len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """Words of the texts ``buf[offsets[i]:offsets[i+1]]``: starts, ends and document of each, and the first word of each text."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
        self.base = int(offsets[0])
        self.buf = buf[self.base : int(offsets[-1])]
        self.offsets = offsets - self.base
        self.docs = len(offsets) - 1
        inside = np.zeros(len(self.buf) + 2, np.int8)
        inside[1:-1] = kind[self.buf]
        step = np.diff(inside)
        starts = step[:-1] == 1 if len(self.buf) else np.zeros(0, bool)
        ends = step[1:] == -1 if len(self.buf) else np.zeros(0, bool)
        cuts = self.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(self.buf))]
        if len(cuts):  # a word doesn't cross into the next text
            both = (inside[cuts] == 1) & (inside[cuts + 1] == 1)
            starts[cuts[both]] = True
            ends[cuts[both] - 1] = True
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.doc = np.repeat(np.arange(self.docs), np.diff(self.first))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool) -> np.ndarray:
        return span_hashes(LOWER[self.buf] if lower else self.buf, self.starts, self.ends)

    def windows(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first word) of each run of ``size`` words within a text."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h = np.zeros(n, np.uint64)
        for j in range(size):
            h = h * np.uint64(0xD6E8FEB86659FD93) + hashes[j : n + j]
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return mix(h[at]), at


def sums(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How often ``mask`` holds within each ``bounds[i]:bounds[i+1]``."""
    return np.diff(np.searchsorted(np.flatnonzero(mask), bounds))


def repeated(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, again): an order in which equal hashes of a document stand together, and of each place in it whether it equals the one before."""
    key = mix(hashes + doc.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    order = np.argsort(key)
    key = key[order]
    again = np.zeros(len(order), bool)
    again[1:] = key[1:] == key[:-1]
    return order, again
