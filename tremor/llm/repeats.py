"""Removal of long repeated byte strings, by a run-length compressed index of what may repeat.

1. Of each window of ``length`` bytes the k-gram of least hash is its anchor; equal windows have equal anchors at equal offsets. The windows
   around one anchor form a context, at most 2 * length bytes. Anchors are counted: where an anchor's k-gram stands at one place only, no window around it repeats.
2. Contexts that are equal as a whole repeat; they need no look at their bytes. Of all other contexts with a shared anchor, and of one context of
   each equal lot, the bytes go to the task of their anchor.
3. There contexts are joined into texts of bounded size, whose suffixes are sorted; the Burrows-Wheeler transform is cut into runs, and longest common
   prefixes are computed at the run ends only. Read in text order, these samples give the matching statistics of every place: between run
   ends a match with the neighbouring suffix loses one byte a place. Places whose match reaches ``length`` start a repeated window.
   Anchors with a crowd of contexts would gather in one task; their windows are dealt out and compared by 128-bit hashes instead, one at a time.
4. The ranges found are gathered by text and cut out.

Texts are known by a 64-bit hash and their size; whole copies of a text are removed as such and searched once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.common import cut, only_columns, pieces, text_buffers, tidy
from tremor.llm.textvec import span_hashes

LENGTH, GRAM = 200, 96
#: Contexts of one anchor that are compared in one task; of more, each window goes to the task of its hash.
CROWD = 8192
#: Bytes of contexts that are sorted at a time; sorts that fit a processor cache take half the time a byte.
INDEX_BYTES = 1 << 18
_PLACE = np.uint64((1 << 28) - 1)


def anchors(buf: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(text, anchor hash, context hash, first window, last window) of each context; places are relative to the text."""
    base = int(offsets[0])
    buf, offsets = buf[base : int(offsets[-1])], offsets - base
    n = len(buf)
    if n < length:
        return [np.zeros(0, np.int64)] * 5
    starts = np.arange(n - gram + 1)
    hashes = span_hashes(buf, starts, starts + gram)
    key = (hashes & ~_PLACE) | starts.astype(np.uint64)
    w = length - gram + 1
    pad = np.full(-len(key) % w, ~np.uint64(0))
    rows = np.concatenate([key, pad]).reshape(-1, w)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    place = (np.minimum(after[:windows], before[w - 1 : w - 1 + windows]) & _PLACE).astype(np.int64)
    size = np.diff(offsets)
    text = np.repeat(np.arange(len(size)), np.maximum(size - length + 1, 0))
    at = np.arange(len(text)) - np.repeat(np.cumsum(np.maximum(size - length + 1, 0)) - np.maximum(size - length + 1, 0), np.maximum(size - length + 1, 0)) + offsets[text]
    if not len(at):
        return [np.zeros(0, np.int64)] * 5
    place = place[at]
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    lo, hi = at[first], at[np.append(first[1:], len(at)) - 1]
    contexts = span_hashes(buf, lo, hi + length)
    text = text[first]
    return text, hashes[place[first]].view(np.int64), contexts.view(np.int64), lo - offsets[text], hi - offsets[text]


def _suffix_order(codes: np.ndarray, packed: np.ndarray, width: int, longest: int) -> np.ndarray:
    """Suffixes in order; ``packed`` orders their first ``width`` symbols. Separators are unequal, so ranks are unique once ``longest`` symbols count."""
    n = len(codes)
    key, h = packed, width
    while True:
        order = np.argsort(key)
        key = key[order]
        rank = np.empty(n, np.int64)
        step = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank[order] = step
        if step[-1] == n - 1 or h > longest:
            return order
        key = rank * (n + 1)
        key[: n - h] += rank[h:] + 1
        h *= 2


def repeated_windows(contexts: list[bytes], length: int) -> np.ndarray:
    """For each place of the contexts, joined with one separator after each, whether a window of ``length`` bytes that starts there starts elsewhere in them too."""
    sizes = np.array([len(c) for c in contexts])
    data = np.frombuffer(b"\xff".join(contexts) + b"\xff", np.uint8)
    n = len(data)
    ends = np.cumsum(sizes + 1) - 1
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    left = ends[owner] - np.arange(n)  # bytes before the separator
    wide = np.concatenate([data.astype(np.int64) + 1, np.zeros(8, np.int64)])
    wide[ends] = 0
    packed = np.zeros(n, np.int64)
    for j in range(5):
        packed = packed << 9 | np.where(left >= j, wide[j : j + n], 0)
    packed = packed << 18 | np.where(left < 5, owner + 1, 0)
    order = _suffix_order(data, packed, 5, int(sizes.max()) + 1)

    symbol = data.astype(np.int64)
    symbol[ends] = 256 + np.arange(len(ends))
    transform = symbol[order - 1]  # the symbol before the first place is the last separator
    bound = np.flatnonzero(transform[1:] != transform[:-1])  # a run ends at this rank, the next begins after it
    a, b = order[bound], order[bound + 1]
    most = np.minimum(left[a], left[b])
    eight = np.zeros(n, np.uint64)
    for j in range(8):
        eight = eight << np.uint64(8) | wide[j : j + n].astype(np.uint64) & np.uint64(255)
    lcp = np.zeros(len(a), np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        x, y = a[live] + lcp[live], b[live] + lcp[live]
        same = (eight[x] == eight[y]) & (most[live] - lcp[live] >= 8)
        rest = live[~same]
        if len(rest):
            diff = eight[a[rest] + lcp[rest]] ^ eight[b[rest] + lcp[rest]]
            equal = np.zeros(len(rest), np.int64)
            going = np.ones(len(rest), bool)
            for j in range(8):
                going &= (diff >> np.uint64(56 - 8 * j)) & np.uint64(255) == 0
                equal += going
            lcp[rest] = np.minimum(lcp[rest] + equal, most[rest])
        live = live[same]
        lcp[live] += 8
        live = live[lcp[live] < most[live]]

    best = np.zeros(n, np.int64)
    for places, none in ((b, order[0]), (a, order[-1])):  # matches with the suffix before, and after
        sampled = np.full(n, -1, np.int64)
        sampled[places] = lcp + places
        sampled[none] = none
        last = np.maximum.accumulate(np.where(sampled >= 0, np.arange(n), 0))
        best = np.maximum(best, sampled[last] - np.arange(n))
    return np.minimum(best, left) >= length


def _ranges(flags: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """Maximal byte ranges covered by windows at the flagged places."""
    at = np.flatnonzero(flags)
    if len(at):
        cuts = np.flatnonzero(np.diff(at) > length)
        yield from zip(at[np.concatenate([[0], cuts + 1])].tolist(), (at[np.append(cuts, len(at) - 1)] + length).tolist(), strict=True)


def find_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """All rows of ``docs`` (doc_id, text) with ``copies`` (rows of the same text) and ``ranges`` (array of lo, hi of bytes that repeat; unordered, may overlap; null if none).

    A text with copies is a repeat as a whole and has no ranges of its own.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", "text", F.xxhash64("text").alias("key"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # of copies of a text that a task meets one brings its anchors
        for b in pieces(batches, "text"):
            new = [k not in seen and not seen.add(k) for k in b.column(1).to_pylist()]
            if not any(new):
                continue
            b = b if all(new) else b.filter(pa.array(new))
            text, fp, context, lo, hi = anchors(*text_buffers(b.column(0)), length, gram)
            yield pa.RecordBatch.from_arrays([b.column(1).take(pa.array(text)), *map(pa.array, (fp, context)), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["key", "fp", "context", "lo", "hi"])

    found = texts.where(F.octet_length("text") >= length).select("text", "key").mapInArrow(tidy(scan), "key long, fp long, context long, lo int, hi int")
    found = found.repartition("fp").dropDuplicates(["fp", "context", "key", "lo", "hi"])
    same, near = Window.partitionBy("fp", "context"), Window.partitionBy("fp")
    found = found.select("*", F.count("*").over(same).alias("n"), F.min("key").over(same).alias("first")).select("*", (F.min("context").over(near) != F.max("context").over(near)).alias("mixed"))
    found = found.where("n > 1 or mixed").select("key", "fp", "lo", "hi", (F.col("n") > 1).alias("whole"), F.expr("mixed and (n = 1 or key = first)").alias("sent"))
    found = cut(found.withColumn("crowd", F.count_if("sent").over(near) > crowd))

    spread = texts.repartition("key")
    rows = texts.groupBy("key").agg(F.count("*").alias("copies"), F.min(F.xxhash64("doc_id")).alias("one"))
    sent = found.where("sent").groupBy("key").agg(F.collect_list(F.struct("fp", "lo", "hi", "crowd")).alias("sent")).join(rows, "key")
    sources = spread.join(sent, "key").where(F.xxhash64("doc_id") == F.col("one")).select("key", "text", "sent")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, text, sent_ in zip(b.column(0), b.column(1), b.column(2), strict=True):
                data, rows_ = text.as_py().encode(), []
                for p in sent_.as_py():
                    if p["crowd"]:
                        for at in range(p["lo"], p["hi"] + 1):
                            h = hashlib.blake2b(data[at : at + length], digest_size=16).digest()
                            rows_.append((int.from_bytes(h[:8], "little", signed=True), at, h[8:]))
                    else:
                        rows_.append((p["fp"], p["lo"], data[p["lo"] : p["hi"] + length]))
                for i in range(0, len(rows_), 4096):
                    fps, los, parts = zip(*rows_[i : i + 4096], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(fps)), pa.array(fps, pa.int64()), pa.array(los, pa.int32()), pa.array(parts, pa.binary())], names=["key", "fp", "lo", "bytes"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, los, parts, fp, size = [], [], [], None, 0
        hashed: dict[bytes, tuple | None] = {}  # the first window of each hash under this fp, until another shows

        def out():
            flags = repeated_windows(parts, length)
            at, rows_ = 0, []
            for key, lo, part in zip(keys, los, parts, strict=True):
                rows_ += [(key, lo + a, lo + z) for a, z in _ranges(flags[at : at + len(part)], length)]
                at += len(part) + 1
            return rows_of(rows_)

        def rows_of(rows_):
            cols = list(zip(*rows_, strict=True)) or [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["key", "lo", "hi"])

        for b in batches:
            pairs: list[tuple] = []
            for key, f, lo, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if f != fp and size > INDEX_BYTES:
                    yield out()
                    keys, los, parts, size = [], [], [], 0
                if f != fp:
                    fp, hashed = f, {}
                if len(part) < length:
                    if part not in hashed:
                        hashed[part] = (key, lo, lo + length)
                    else:
                        if first := hashed[part]:
                            pairs.append(first)
                            hashed[part] = None
                        pairs.append((key, lo, lo + length))
                    continue
                keys.append(key)
                los.append(lo)
                parts.append(part)
                size += len(part)
            if pairs:
                yield rows_of(pairs)
        if parts:
            yield out()

    contexts = sources.mapInArrow(tidy(split), "key long, fp long, lo int, bytes binary").repartition("fp").sortWithinPartitions("fp")
    marks = contexts.mapInArrow(tidy(index), "key long, lo int, hi int")
    marks = marks.union(found.where("whole").select("key", "lo", (F.col("hi") + length).alias("hi")))
    single = marks.join(rows.where("copies = 1").select("key"), "key", "left_semi").groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    return spread.join(rows.select("key", "copies").join(single, "key", "left"), "key").select("doc_id", "text", "copies", "ranges")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, kept (binary).

    Removes each byte covered by a string of ``length`` bytes that also starts anywhere else, in the same text or another. A null text is empty; texts
    under ``length`` bytes lose nothing. Repeated rows are copies of each other, whatever their ids.
    """
    found = find_repeats(only_columns(docs, "doc_id", "text"), length, gram, crowd)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, copies, ranges in zip(b.column(1), b.column(2).to_pylist(), b.column(3), strict=True):
                data = text.as_py().encode()
                n = len(data)
                spans: list[list[int]] = []
                if copies > 1 and n >= length:
                    spans = [[0, n]]
                elif ranges.is_valid:
                    v = ranges.values
                    for lo, hi in sorted(zip(v.field(0).to_pylist(), v.field(1).to_pylist(), strict=True)):
                        if spans and lo <= spans[-1][1]:
                            spans[-1][1] = max(hi, spans[-1][1])
                        else:
                            spans.append([lo, hi])
                ends = [0, *(x for s in spans for x in s), n]
                kept = b"".join(data[a:z] for a, z in zip(ends[::2], ends[1::2], strict=True))
                rows.append((n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
            cols = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return found.mapInArrow(tidy(run), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
