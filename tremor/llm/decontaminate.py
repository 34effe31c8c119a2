"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``window`` consecutive words of the benchmark items; an item of fewer words is one window.
The symbols of the search are words, its blocks the last ``BLOCK`` words under the search window: a shift table keyed by block
skips the positions at which no pattern can end, a bucket keyed by the block at a pattern's end selects the patterns that can,
and direct comparison of the words confirms them. Patterns of one length share a search, so short items don't shorten the
shifts of the others.

The patterns go to the executors in parts of at most ``PART_BYTES`` of benchmark text; each document is searched for every part. A task has the tables of one part at a
time, so what it holds is bounded whatever the size of the benchmark. Documents are neither shuffled nor split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import only_columns, pieces, share, text_buffers, tidy, unwrapped, wrapped

WINDOW = 10
BLOCK = 3
PART_BYTES = 8 << 20
#: Bytes of text that a task holds while it goes through the parts.
HELD_BYTES = 8 << 20

_FOUND = "struct<n_words: bigint, n_hit: bigint, n_items: bigint, items_sha256: string, contaminated: boolean, items: array<string>, hits: array<int>>"

_SPACES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: str | bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased, as UTF-8."""
    if text is None:
        return []
    data = text.encode() if isinstance(text, str) else text
    return data.translate(_SPACES).split()


class Search:
    """Wu-Manber tables for patterns of one length in words."""

    def __init__(self, length: int):
        self.length, self.block = length, min(BLOCK, length)
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, set]] = {}

    def add(self, pattern: tuple, item) -> None:
        m, b = self.length, self.block
        for at in range(m - b + 1):
            key = pattern[at : at + b]
            self.shift[key] = min(self.shift.get(key, m - b + 1), m - b - at)
        self.buckets.setdefault(pattern[m - b :], {}).setdefault(pattern, set()).add(item)

    def scan(self, words: tuple) -> Iterator[tuple[int, set]]:
        """(end, items) of each place at which a pattern ends."""
        m, b = self.length, self.block
        far, shift, buckets = m - b + 1, self.shift.get, self.buckets
        end, n = m, len(words)
        while end <= n:
            key = words[end - b : end]
            by = shift(key, far)
            if by:
                end += by
                continue
            items = buckets[key].get(words[end - m : end])
            if items is not None:
                yield end, items
            end += 1


def searches(items: Iterable[tuple[object, str | None]], window: int) -> list[Search]:
    found: dict[int, Search] = {}
    for item, text in items:
        words = tuple(words_of(text))
        m = min(window, len(words))
        if m:
            search = found.setdefault(m, Search(m))
            for at in range(len(words) - m + 1):
                search.add(words[at : at + m], item)
    return list(found.values())


def hits_of(words: tuple, tables: Iterable[list[Search]]) -> tuple[list[tuple[int, int]], set]:
    """Disjoint ascending spans of words inside any occurrence, and the items that occur."""
    spans, items = [], set()
    for part in tables:
        for search in part:
            for end, who in search.scan(words):
                spans.append((end - search.length, end))
                items |= who
    merged: list[list[int]] = []
    for lo, hi in sorted(spans):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(hi, merged[-1][1])
        else:
            merged.append([lo, hi])
    return [(a, b) for a, b in merged], items - {None}


def _parts(benchmark: DataFrame, most: int):
    """Items in parts of about ``most`` bytes of text at most, one part on the driver at a time."""
    part, size = [], 0
    for row in only_columns(benchmark, "item_id", "text").where(F.col("text").isNotNull()).distinct().toLocalIterator():
        if part and size + len(row.text) > most:
            yield part
            part, size = [], 0
        part.append((None if row.item_id is None else str(row.item_id), row.text))
        size += len(row.text)
    if part:
        yield part


def search_columns(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows of ``docs`` (doc_id, text and whatever else it has) with a column ``found`` (one of that name is replaced), a struct of

    n_words, n_hit (words inside any occurrence of a window), n_items (items with occurring windows), items_sha256 (of their ids, sorted
    as strings, comma-joined), contaminated (n_hit > 0), items, and hits (flat list of first and last-plus-one words of the hit spans).

    A null or empty text has no words and is not contaminated. An item without text or words has no window; the windows of an item
    without id hit words, but the item is not counted. Items that repeat an id count once. Every row gets its own result, repeated ids
    included. A benchmark without items leaves all documents clean.
    """
    parts = [share(docs.sparkSession, p) for p in _parts(benchmark, part_bytes)]
    rows = wrapped(docs, F.col("`text`"))
    searched = rows.mapInArrow(tidy(lambda batches: search_batches(batches, parts, window)), f"row {rows.schema['row'].dataType.simpleString()}, found {_FOUND}")
    return unwrapped(searched, docs.columns, found=F.col("found"))


def search_batches(batches: Iterator[pa.RecordBatch], parts: list, window: int, most: int = HELD_BYTES) -> Iterator[pa.RecordBatch]:
    """row and found of batches of row and text. About ``most`` bytes of text are held and searched for one part after the other, so tables of one part exist at a time, and are built once
    for that much text; those of the last part stay for the next text, which begins with it."""
    held, size, built = [], 0, (None, [])

    def tables(k: int) -> list[Search]:
        nonlocal built
        if built[0] != k:
            built = (None, [])
            built = (k, searches(parts[k].value, window))
            vars(parts[k]).pop("_value", None)  # the tables hold what is needed of it
        return built[1]

    def out() -> Iterator[pa.RecordBatch]:
        nonlocal held, size
        spans: list[list] = [[] for b in held for _ in range(b.num_rows)]
        items: list[set] = [set() for _ in spans]
        order = list(range(len(parts)))
        for k in order if built[0] in (None, 0) else order[::-1]:
            own = tables(k)
            for i, text in enumerate(t for b in held for t in b.column(1)):
                more, who = hits_of(tuple(words_of(text.as_py())), [own])
                spans[i] += more
                items[i] |= who
        at = 0
        for b in held:
            yield pa.RecordBatch.from_arrays([b.column(0), _found(b.column(1), spans[at : at + b.num_rows], items[at : at + b.num_rows])], names=["row", "found"])
            at += b.num_rows
        held, size = [], 0

    for b in pieces(batches, "text", most):
        held.append(b)
        _, ends = text_buffers(b.column(1))
        size += int(ends[-1] - ends[0])
        if size >= most:
            yield from out()
    yield from out()


def _found(texts: pa.Array, spans: list[list], items: list[set]) -> pa.Array:
    rows = []
    for text, some, who in zip(texts, spans, items, strict=True):
        flat: list[int] = []
        for lo, hi in sorted(some):
            if flat and lo <= flat[-1]:
                flat[-1] = max(hi, flat[-1])
            else:
                flat += [lo, hi]
        ids = sorted(who)
        rows.append(
            {
                "n_words": len(words_of(text.as_py())), "n_hit": sum(flat[1::2]) - sum(flat[::2]), "n_items": len(ids), "items_sha256": hashlib.sha256(",".join(ids).encode()).hexdigest(),
                "contaminated": bool(flat), "items": ids, "hits": flat,
            }
        )
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("items", pa.list_(pa.string())), ("hits", pa.list_(pa.int32()))])
    return pa.array(rows, kind)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per document: doc_id and the fields of ``search_columns``."""
    found = search_columns(only_columns(docs, "doc_id", "text"), benchmark, window, part_bytes)
    return found.select("doc_id", "found.*")
