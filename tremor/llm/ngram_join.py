"""N-gram Jaccard self-join with a prefix tree.

Every text is the set of its word n-grams (64-bit hashes). Sets link when their Jaccard similarity reaches a threshold; the result
is the component of each document.

1. A fixed-size sketch of how many documents hold each n-gram gives all sets one global order, rare n-grams first.
2. Two sets that link share an n-gram among their first |x| - ceil(t |x|) + 1 in that order. Sets that share one so are tied, unless their sizes or their
   counts of n-grams in a few buckets show that their overlap cannot reach the threshold, or ties seen before join them already. The components of the
   ties hold every link. Equal sets are one node from here on.
3. Sets of such components are sent once to the task of their component (a large one is dealt out in pairs of blocks). There they
   are stored in a trie of token blocks, shared n-grams first, so near copies share their paths. A set is looked up level by level for all paths at
   once; a path carries the overlap so far, which its whole subtree shares, and is cut when the n-grams left below it or in the
   query cannot reach the overlap that its sizes need, or when all below it is known to be in the query's component.
4. The links found, a spanning forest of each component, are joined to components of the corpus.

Sets are compared whole and exactly but for 64-bit hashes: of N distinct n-gram sets some two share a hash by chance with a
probability below N^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import cut, only_columns, pieces, share, text_buffers, tidy
from tremor.llm.graph import components
from tremor.llm.textvec import SPACED, Words, mix

#: Cells of the sketch that orders n-grams, in slices of SLICE; bits of the filter of candidate documents; sets in a block of a component.
CELLS, SLICE, BITS, BLOCK = 1 << 22, 1 << 18, 1 << 23, 2048
#: Tokens in a node of the trie, and sets up to which pairs are compared without one.
NODE, FEW = 32, 6
#: Buckets that n-grams of a set are counted in; the sums of smaller counts bound an overlap from above.
BUCKETS = 128


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, bounds, signature): the distinct n-grams of text i, ascending, at bounds[i]:bounds[i+1], and a hash of the set. A text of fewer words is one n-gram; of none, the empty set."""
    w = Words(*text_buffers(texts), SPACED)
    hashes = w.hashes(lower=True)
    grams, at = w.windows(hashes, size)
    doc = w.doc[at]
    n = w.counts
    few = np.flatnonzero((n > 0) & (n < size))
    if len(few):
        whole = [mix(np.array([n[i]], np.uint64) + np.bitwise_xor.reduce(mix(hashes[w.first[i] : w.first[i + 1]] + np.arange(1, n[i] + 1, dtype=np.uint64))))[0] for i in few]
        grams, doc = np.concatenate([grams, np.array(whole, np.uint64)]), np.concatenate([doc, few])
    grams = grams.view(np.int64)
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    keep = np.ones(len(grams), bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    grams, doc = grams[keep], doc[keep]
    bounds = np.searchsorted(doc, np.arange(w.docs + 1))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams.view(np.uint64)))])
    signature = mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64))
    return grams, bounds, signature.view(np.int64)


def _cell(grams: np.ndarray) -> np.ndarray:
    return (mix(grams.view(np.uint64)) >> np.uint64(17)).astype(np.int64) % CELLS


def frequency_sketch(docs: DataFrame, size: int) -> np.ndarray:
    """For each cell the number of documents with an n-gram in it. Partitions count, slices of their counts are summed by slice: the sketch has one size for any corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int32)
        for b in pieces(batches, "text"):
            which, n = np.unique(_cell(shingle_sets(b.column(0), size)[0]), return_counts=True)
            cells[which] += n.astype(np.int32)
        if cells.any():  # a task's counts over 255 are frequent enough to stand at the end of the order
            parts = [np.minimum(cells[i : i + SLICE], 255).astype(np.uint8).tobytes() for i in range(0, CELLS, SLICE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names=["slice", "cells"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(v.as_buffer(), np.uint8).astype(np.int64)
        for k, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.minimum(v, 2**31 - 1).astype(np.int32).tobytes()])], names=["slice", "cells"])

    kind = "slice int, cells binary"
    rows = docs.select("text").mapInArrow(tidy(count), kind).repartition(CELLS // SLICE, "slice").mapInArrow(add, kind).collect()
    out = np.zeros(CELLS, np.int32)
    for r in rows:
        out[r.slice * SLICE : (r.slice + 1) * SLICE] = np.frombuffer(r.cells, np.int32)
    return out


def _prefixes(docs: DataFrame, size: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """doc_id, sig, n, prefix (array of the n-grams that a linked set must share one of) and counts of each row. Of equal sets that a task meets the first brings the prefix."""
    cells = share(docs.sparkSession, sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq, seen = cells.value, set()
        for b in pieces(batches, "text"):
            grams, bounds, sig = shingle_sets(b.column(1), size)
            n = np.diff(bounds)
            again = np.zeros(len(n), bool)
            for i, (known, s) in enumerate(zip(b.column(0).is_valid().to_pylist(), sig.tolist(), strict=True)):
                again[i] = s in seen
                if known:
                    seen.add(s)
            doc = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((grams, freq[_cell(grams)], doc))
            take = np.where((n > 0) & ~again, n - -(-percent * n // 100) + 1, 0)
            first = np.arange(len(grams)) - bounds[doc] < take[doc]
            ends = np.concatenate([[0], np.cumsum(take)]).astype(np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(ends), pa.array(grams[order][first]))
            place = (mix(grams.view(np.uint64)) >> np.uint64(57)).astype(np.int64)
            count = np.minimum(np.bincount(doc * BUCKETS + place, minlength=BUCKETS * len(n)), 255).astype(np.uint8).reshape(len(n), BUCKETS)
            counts = pa.array([c.tobytes() for c in count], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sig), pa.array(n.astype(np.int64)), prefix, counts], names=["doc_id", "sig", "n", "prefix", "counts"])

    return docs.mapInArrow(tidy(run), f"doc_id {dict(docs.dtypes)['doc_id']}, sig long, n long, prefix array<long>, counts binary")


def _ties(posts: DataFrame, percent: int) -> DataFrame:
    """(a, b): ties between sets that share an n-gram; ``posts``: gram, n, sig, counts, sorted by gram and n within partitions.

    Of one n-gram only sets whose sizes can link with the next one are held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while (y := up.get(x, x)) != x:
                up[x] = up.get(y, y)
                x = y
            return x

        gram, sizes, sigs, rows = None, [], [], []
        for b in batches:
            out: list[tuple[int, int]] = []
            for g, n, sig, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if g != gram:
                    gram, sizes, sigs, rows = g, [], [], []
                if sizes and 100 * sizes[0] < percent * n:
                    at = np.searchsorted(sizes, -(-percent * n // 100))
                    sizes, sigs, rows = sizes[at:], sigs[at:], rows[at:]
                own = root(sig)
                other = [i for i, s in enumerate(sigs) if root(s) != own]
                if other:
                    mine = np.frombuffer(counts, np.uint8)
                    theirs = np.frombuffer(b"".join([rows[i] for i in other]), np.uint8).reshape(-1, BUCKETS)
                    bound = np.minimum(theirs, mine).sum(axis=1, dtype=np.int64)
                    full = (theirs == 255).any(axis=1) & (mine == 255).any()
                    need = percent * (np.array([sizes[i] for i in other]) + n)
                    for k in np.flatnonzero(full | ((100 + percent) * bound >= need)):
                        x, y = root(sigs[other[k]]), root(sig)
                        if x != y:
                            up[max(x, y)] = min(x, y)
                            out.append((sig, sigs[other[k]]))
                if not (sigs and sigs[-1] == sig):
                    sizes.append(n)
                    sigs.append(sig)
                    rows.append(counts)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    return posts.select("gram", "n", "sig", "counts").mapInArrow(tidy(run), "a long, b long")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep and text of the rows whose id passes a fixed-size filter of the ids in ``wanted`` (rep): all of those, and few others. Text is sent rather than sets, whose hashes don't compress."""
    place = F.pmod(F.xxhash64("rep"), F.lit(BITS))
    words = wanted.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits")).toArrow()
    bits = np.zeros(BITS >> 6, np.uint64)
    bits[words.column("w").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    shared = share(docs.sparkSession, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = b.column(2).to_numpy()
            b = b.filter(pa.array((shared.value[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1))
            yield pa.RecordBatch.from_arrays(b.columns[:2], names=["rep", "text"])

    rows = docs.where("doc_id is not null").select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(BITS)).alias("p"))
    return rows.mapInArrow(tidy(run), f"rep {dict(docs.dtypes)['doc_id']}, text string")


class Trie:
    """Prefix tree of sets of small ints; a node is a block of up to NODE tokens, and levels hold the nodes of one depth."""

    def __init__(self, sets: list[np.ndarray]):
        """``sets``: ascending arrays in lexicographic order."""
        k = len(sets)
        self.sizes = np.array([len(s) for s in sets])
        common = np.zeros(k, np.int64)
        for i in range(1, k):
            m = min(len(sets[i - 1]), len(sets[i]))
            diff = np.flatnonzero(sets[i - 1][:m] != sets[i][:m])
            common[i] = diff[0] if len(diff) else m
        self.levels = []
        inside = np.arange(k)  # sets that reach this level, in order
        above = np.zeros(k, np.int64)  # the node of each at the level above
        depth = 0
        while len(inside):
            end = np.minimum(self.sizes[inside], depth + NODE)
            new = np.ones(len(inside), bool)
            follows = np.diff(inside) == 1
            new[1:] = ~(follows & (common[inside[1:]] >= end[1:]) & (end[1:] == end[:-1]))
            first = np.flatnonzero(new)
            node = np.cumsum(new) - 1
            last = np.append(first[1:], len(inside)) - 1
            tokens = np.concatenate([sets[inside[f]][depth : end[f]] for f in first])
            bounds = np.concatenate([[0], np.cumsum(end[first] - depth)])
            size = self.sizes[inside]
            self.levels.append(
                {
                    "parent": above[inside[first]], "tokens": tokens, "bounds": bounds, "lo": inside[first], "hi": inside[last] + 1, "end": end[first],
                    "least": np.minimum.reduceat(size, first), "most": np.maximum.reduceat(size, first), "leaf": size[first] == end[first],
                }
            )
            above[inside] = node
            inside = inside[size > end]
            depth += NODE

    def search(self, y: np.ndarray, flags: np.ndarray, after: int, same: np.ndarray, percent: int) -> list[int]:
        """Stored sets from ``after`` on that link with ``y`` and are not ``same`` (a running count of sets in y's component)."""
        found: list[int] = []
        ny = len(y)
        overlap = np.zeros(1, np.int64)
        alive = np.ones(1, bool)
        for depth, level in enumerate(self.levels):
            parent = level["parent"] if depth else np.zeros(len(level["lo"]), np.int64)
            lo, hi = level["lo"], level["hi"]
            go = alive[parent] & (hi > after) & (same[hi] - same[lo] < hi - lo) & (100 * level["most"] >= percent * ny) & (percent * level["least"] <= 100 * ny)
            own = np.zeros(len(lo), np.int64)
            at = np.flatnonzero(go)
            if not len(at):
                break
            b = level["bounds"]
            if 2 * len(at) > len(lo):
                own = np.add.reduceat(flags[level["tokens"]], b[:-1])
            else:
                size = b[at + 1] - b[at]
                index = np.repeat(b[at] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                own[at] = np.add.reduceat(flags[level["tokens"][index]], np.concatenate([[0], np.cumsum(size)[:-1]]))
            now = overlap[parent] + own
            best = now + np.minimum(level["most"] - level["end"], ny - now)
            go &= (100 + percent) * best >= percent * (level["least"] + ny)
            for i in np.flatnonzero(go & level["leaf"]):
                if (100 + percent) * now[i] >= percent * (level["end"][i] + ny):
                    found += [s for s in range(max(lo[i], after), hi[i]) if self.sizes[s] == level["end"][i]]
            overlap, alive = now, go
        return found


def linked(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``sets`` (ascending int64 arrays, none empty), as pairs of places."""
    k = len(sets)
    links: list[tuple[int, int]] = []
    comp = np.arange(k)

    def join(i: int, j: int) -> None:
        if comp[i] != comp[j]:
            links.append((i, j))
            comp[comp == comp[j]] = comp[i]

    if k <= FEW:
        whole = [set(s.tolist()) for s in sets]
        for i in range(k):
            for j in range(i + 1, k):
                if comp[i] != comp[j]:
                    x, y = whole[i], whole[j]
                    if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and (100 + percent) * len(x & y) >= percent * (len(x) + len(y)):
                        join(i, j)
        return links
    _, back, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    own = [np.sort(rank[back[bounds[i] : bounds[i + 1]]]) for i in range(k)]
    order = sorted(range(k), key=lambda i: own[i].astype(">u4").tobytes())
    own = [own[i] for i in order]
    trie = Trie(own)
    flags = np.zeros(len(counts), np.int64)
    for i, y in enumerate(own):
        flags[y] = 1
        same = np.concatenate([[0], np.cumsum(comp == comp[i])])
        for j in trie.search(y, flags, i + 1, same, percent):
            join(i, j)
        flags[y] = 0
    return [(order[i], order[j]) for i, j in links]


def _links(groups: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): links within each (root, i, j) of ``groups`` (with sig and text), whose rows lie together; a group holds two blocks at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}

        def flush():
            sigs = sorted(held)
            pairs = linked([held[s] for s in sigs], percent) if len(sigs) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([sigs[i] for i, _ in pairs], pa.int64()), pa.array([sigs[j] for _, j in pairs], pa.int64())], names=["a", "b"])

        for b in pieces(batches, "text"):
            grams, bounds, own = shingle_sets(b.column(4), size)
            for k, (*now, sig) in enumerate(zip(*(c.to_pylist() for c in b.columns[:4]), strict=True)):
                if now != key:
                    if len(held) > 1:
                        yield flush()
                    key, held = now, {}
                if own[k] == sig and sig not in held:  # another row may have the id of the one that is wanted
                    held[sig] = grams[bounds[k] : bounds[k + 1]].copy()
        if len(held) > 1:
            yield flush()

    return groups.select("root", "i", "j", "sig", "text").mapInArrow(tidy(run), "a long, b long")


def join_components(docs: DataFrame, size: int = 4, percent: int = 85, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    A-Z are lower-cased; words are ``[^\\x20\\x09-\\x0D]+``. Sets link when 100 * |x & y| >= percent * |x | y|. component_id is the smallest doc_id
    reachable by links, itself included. A null or empty text has n_shingles 0 and is linked with nothing. A row without doc_id is linked with nothing
    and has a null component. Rows that repeat an id are rows of their own; equal texts are linked whatever their number.
    """
    docs = only_columns(docs, "doc_id", "text")
    keys = cut(_prefixes(docs, size, percent, frequency_sketch(docs, size)))
    some = keys.where("n > 0 and doc_id is not null")
    # Posts are sent once, for the count and for the join. Of n-grams that the same sets share one is enough.
    posts = some.select(F.explode("prefix").alias("gram"), "sig").repartition("gram").dropDuplicates(["gram", "sig"])
    shared = posts.groupBy("gram").agg(F.min("sig").alias("a"), F.max("sig").alias("z"), F.count("*").alias("n"), F.bit_xor("sig").alias("x")).where("a < z")
    shared = shared.groupBy("a", "z", "n", "x").agg(F.min("gram").alias("gram"))
    alike = posts.join(shared.select("gram"), "gram")
    counts = some.groupBy("sig").agg(F.min("n").alias("n"), F.min("counts").alias("counts"))
    dealt = alike.join(counts, "sig").repartition("gram").sortWithinPartitions("gram", "n", "sig")
    ties = _ties(dealt, percent)
    roots = components(ties)
    nodes = some.groupBy("sig").agg(F.min("doc_id").alias("rep")).join(roots.toDF("sig", "root"), "sig")
    blocks = nodes.join(roots.groupBy("root").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "root")
    wanted = cut(blocks.select("sig", "rep", "root", "blocks", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int").alias("own")))
    texts = _texts(docs, wanted).join(wanted, "rep")
    dealt = texts.select("root", "sig", "text", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    dealt = dealt.select("root", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "sig", "text")
    groups = dealt.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    found = components(_links(groups, size, percent))
    rooted = keys.select("doc_id", "n", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("sig")).alias("sig")).join(found.toDF("sig", "root"), "sig", "left")
    rooted = rooted.select("doc_id", "n", F.coalesce("root", "sig").alias("root"))
    least = rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return rooted.join(least, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
