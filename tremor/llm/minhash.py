"""One-permutation MinHash of the character shingles of many lines at once, and exact Jaccard similarity of pairs of lines.

A shingle is ``gram`` consecutive characters, from each character of a line on; a shorter line is one shingle. Its hash deals it to one of the ``slots``
of the signature, each of which keeps its minimum. A slot without a shingle takes the minimum of the first slot that has one in an order of its
own (optimal densification), so slots of lines of few shingles agree as independently as those of long lines: with the Jaccard similarity for probability.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

from tremor.llm.common import text_buffers
from tremor.llm.textvec import M1, M2, mix

#: Characters that one step hashes; a longer line takes several.
STEP = 1 << 18
#: High bits of a key that tell the pairs of a step apart.
PAIR_BITS = 12

_FACTOR = 0xD6E8FEB86659FD93
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, bounds) of texts without nulls."""
    data, ends = text_buffers(texts)
    data = data[int(ends[0]) : int(ends[-1])]
    codes = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) == len(data):
        return codes, ends - ends[0]
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return codes, starts[ends - ends[0]]


def shingle_hashes(codes: np.ndarray, bounds: np.ndarray, gram: int):
    """Steps of (hashes, lines): the hash of the shingle at each place that has one, and the line that it is in, ascending."""
    sizes = np.diff(bounds)
    short = np.flatnonzero((sizes > 0) & (sizes < gram))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for j in range(gram - 1):
            there = sizes[short] > j
            whole[there] = whole[there] * np.uint64(_FACTOR) + codes[bounds[short[there]] + j] + np.uint64(1)
        yield mix(whole + sizes[short].astype(np.uint64) * M2), short
    places = np.maximum(sizes - gram + 1, 0)
    for lo in range(0, len(codes) - gram + 1, STEP):
        hi = min(lo + STEP, len(codes) - gram + 1)
        first, last = np.searchsorted(bounds, [lo, hi - 1], "right") - 1
        lines = np.arange(first, last + 1)
        here = np.minimum(bounds[lines] + places[lines], hi) - np.maximum(bounds[lines], lo)
        line = np.repeat(lines, np.maximum(here, 0))
        wide = codes[lo : hi + gram - 1].astype(np.uint64) + np.uint64(1)
        h = wide[: hi - lo].copy()
        for j in range(1, gram):
            h *= np.uint64(_FACTOR)
            h += wide[j : hi - lo + j]
        if len(line) < hi - lo:
            from_ = np.maximum(bounds[lines], lo) - lo
            inside = np.zeros(hi - lo + 1, np.int8)
            some = here > 0
            np.add.at(inside, from_[some], 1)
            np.add.at(inside, (from_ + here)[some], -1)
            h = h[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        yield mix(h), line


@functools.lru_cache(2)
def _orders(slots: int) -> np.ndarray:
    """For each slot an order of all slots, its own first."""
    draw = np.random.default_rng(20240611)
    out = np.empty((slots, slots), np.int64)
    for k in range(slots):
        rest = draw.permutation(slots)
        out[k] = np.concatenate([[k], rest[rest != k]])
    return out


def signatures(texts: pa.Array, gram: int, slots: int) -> np.ndarray:
    """Array of shape (lines, slots); every line has a character."""
    codes, bounds = _characters(texts)
    low = np.full(len(texts) * slots, _EMPTY)
    for hashes, line in shingle_hashes(codes, bounds, gram):
        slot = ((hashes >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)
        np.minimum.at(low, line * slots + slot.astype(np.int64), hashes & np.uint64(0xFFFFFFFF))
    return densified(low.reshape(-1, slots))


def one_permutation(hashes: np.ndarray, rows: np.ndarray, n: int, slots: int) -> np.ndarray:
    """Signatures of shape (n, slots) of sets of 64-bit ``hashes``, each an element of the set of its row; every set has an element."""
    low = np.full(n * slots, _EMPTY)
    slot = ((hashes >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)
    np.minimum.at(low, rows * slots + slot.astype(np.int64), hashes & np.uint64(0xFFFFFFFF))
    return densified(low.reshape(-1, slots))


def densified(low: np.ndarray) -> np.ndarray:
    """Signatures whose empty slots take the minimum of the first slot that has one, in an order of their own."""
    slots = low.shape[1]
    line, slot = np.nonzero(low == _EMPTY)
    full, orders = low.copy(), _orders(slots)
    for j in range(1, slots):
        if not len(line):
            break
        got = low[line, orders[slot, j]]
        there = got != _EMPTY
        full[line[there], slot[there]] = got[there]
        line, slot = line[~there], slot[~there]
    return full


def bands(low: np.ndarray, n: int) -> np.ndarray:
    """Array of shape (lines, n): a hash of each band. Band b holds the slots b, b + n, b + 2 n and so on."""
    out = np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64) * M1, (len(low), n)).copy()
    for at in range(0, low.shape[1], n):
        out = mix(out * np.uint64(_FACTOR) + low[:, at : at + n])
    return out.view(np.int64)


def sketch(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two longs of a bit of each slot; slots that differ differ in half of the bits."""
    bits = mix(low + np.arange(low.shape[1], dtype=np.uint64) * M2) & np.uint64(1)
    half = (low.shape[1] + 1) // 2
    words = [(b << np.arange(b.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64) for b in (bits[:, :half], bits[:, half:])]
    return words[0], words[1]


def most_bits(slots: int, similarity: float) -> int:
    """Bits of two sketches that differ at most for lines of that similarity, but for once in some ten million."""
    p = (1 - similarity) / 2
    return int(np.ceil(slots * p + 5.5 * np.sqrt(slots * p * (1 - p))))


def _keys(texts: pa.Array, gram: int) -> np.ndarray:
    """The sets of shingles as ascending keys: the place of the text in the high bits, hashes below."""
    rest = np.uint64(64 - PAIR_BITS)
    keys = [(line.astype(np.uint64) << rest) | (h >> np.uint64(PAIR_BITS)) for h, line in shingle_hashes(*_characters(texts), gram)]
    keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def shingle_sets(texts: pa.Array, gram: int) -> list[np.ndarray]:
    """The set of shingles of each text as ascending 64-bit hashes."""
    hashes, lines = zip(*shingle_hashes(*_characters(texts), gram), strict=True) if len(texts) else ([], [])
    if not hashes:
        return [np.zeros(0, np.uint64)] * len(texts)
    h, line = np.concatenate(hashes), np.concatenate(lines)
    order = np.argsort(line, kind="stable")
    bounds = np.searchsorted(line[order], np.arange(len(texts) + 1))
    h = h[order]
    return [np.unique(h[lo:hi]) for lo, hi in zip(bounds, bounds[1:], strict=False)]


def joined(texts: pa.Array, f: np.ndarray, g: np.ndarray, roots: np.ndarray, side: np.ndarray, gram: int, most: int, similarity: float) -> list[tuple[int, int]]:
    """Links (places) between similar texts of different ``roots``, as many as join what they can join. ``side``: 0, 1, or 2; a 0 is not compared with a 0, nor a 1 with a 1.

    Sketches ``f`` and ``g`` that differ in more than ``most`` bits spare a comparison.
    """
    n = len(roots)
    _, comp = np.unique(roots, return_inverse=True)
    near = []
    for i in range(n - 1):
        other = slice(i + 1, n)
        some = (comp[other] != comp[i]) & ((side[other] != side[i]) | (side[other] == 2))
        if some.any():
            some &= np.bitwise_count(f[other] ^ f[i]).astype(np.int16) + np.bitwise_count(g[other] ^ g[i]) <= most
            if len(found := np.flatnonzero(some) + i + 1):
                near.append((i, found))
    if not near:
        return []
    wanted = np.zeros(n, bool)  # most lines of a bucket are near none of another component, and need no set
    for i, found in near:
        wanted[i] = wanted[found] = True
    place = np.cumsum(wanted) - 1
    sets = shingle_sets(texts.take(pa.array(np.flatnonzero(wanted))), gram)
    _, back = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    flags, links = np.zeros(int(back.max()) + 1, np.int64), []
    for i, found in near:
        found = found[comp[found] != comp[i]]  # some may be joined by now
        if not len(found):
            continue
        own, others = back[bounds[place[i]] : bounds[place[i] + 1]], [back[bounds[k] : bounds[k + 1]] for k in place[found]]
        flags[own] = 1
        sizes = np.array([len(s) for s in others])
        common = np.add.reduceat(flags[np.concatenate(others)], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
        flags[own] = 0
        for j in found[common >= similarity * (sizes + len(own) - common) - 1e-9].tolist():
            if comp[j] != comp[i]:
                links.append((i, j))
                comp[comp == comp[j]] = comp[i]
    return links


def overlaps(x: pa.Array, y: pa.Array, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(size of the intersection, size of the union) of the sets of shingles of x[i] and y[i], which are at most 2^PAIR_BITS and hold a character each."""
    a, b, n = _keys(x, gram), _keys(y, gram), len(x)
    both = np.sort(np.concatenate([a, b]))
    count = lambda keys: np.bincount((keys >> np.uint64(64 - PAIR_BITS)).astype(np.int64), minlength=n)
    common = count(both[1:][both[1:] == both[:-1]])
    return common, count(both) - common
