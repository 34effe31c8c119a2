"""Byte-level BPE encoding and decoding with the ranks of a public tokenizer file.

Texts are cut into words by the tokenizer's pattern. Words that are tokens encode as such. For all others Spark higher-order functions fold
the ranked merges over the word's byte array: the state of ``aggregate`` is the parts so far and the rank of each adjacent pair, a step merges
the leftmost pair of least rank. Ranks come from a literal map of token pairs, laid out as two arrays (a perfect hash), since Spark looks keys of
a map literal up one by one.

Distinct words that stand more than once in the corpus are folded first, once each, the ``WORDS`` most frequent ones at most, and sent to the tasks as arrays
of their 64-bit hashes and ids (about 20 bytes a word). Of all other words each document folds its distinct ones by the same expression. The bound
only moves work, not results. A word is taken for another one of the dictionary with a probability of WORDS / 2^64, and pieces of text that a task has at hand by hashes of theirs likewise. A step of the fold takes time in
the length of a word, so one of over ``LONG`` bytes would take the square of its length; such words are merged with a heap in Python instead.

Both folds are written to the shared folder, so plans that hold the literal don't outlive them, and a lost executor doesn't repeat them.
Decoding concatenates the binary pieces of the ids.

The vocabulary file is read on the driver; its path is a parameter.
"""

from __future__ import annotations

import base64
import contextlib
import functools
import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import cut, drop, give_back, give_back_driver, pieces, share, text_buffers, tidy, unwrapped, wrapped
from tremor.llm.textvec import byte_class, span_hashes

#: Words in the dictionary at most; words that a task counts at a time; bytes of text that a task looks at, and hashes, at a time.
WORDS, COUNTED, LOOKED, HASHED = 1 << 21, 1 << 20, 1 << 20, 1 << 20
#: Fixed value: the pattern of a public tokenizer, whose words are found without a regular expression.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of the longest word that is folded.
LONG = 512
MISS = 0xFFFFFFFF
#: A part that merges with no next one: over every rank.
NONE = 1 << 62
#: Bits of the largest token id that the states of a fold have room for.
MOST_BITS = 18

#: White space of Unicode; the pattern's own \s differs between regular expression libraries in a few control characters.
_WHITE = r"\t-\r\x20\x85\xa0  -     　"


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.split(b"\n") if line.strip())}


def read_ranks(path: str) -> dict[bytes, int]:
    return parse_ranks(_file(path))


def _file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


@functools.lru_cache(16)
def _ranges(kind: str) -> str:
    """The characters of a Unicode property up to U+FFFF as ranges of a character class."""
    import regex

    out = []
    for first, last in ((0, 0xD800), (0xE000, 0x10000)):
        for run in regex.findall(rf"\p{{{kind}}}+", "".join(map(chr, range(first, last)))):
            lo = 0
            for k in range(1, len(run) + 1):
                if k == len(run) or ord(run[k]) != ord(run[k - 1]) + 1:
                    out.append(f"\\u{ord(run[lo]):04x}-\\u{ord(run[k - 1]):04x}")
                    lo = k
    return "".join(out)


@functools.lru_cache(4)
def word_finder(pattern: str):
    """A function from a text to its words. Texts without characters over U+FFFF are searched by the standard library's engine with Unicode properties spelled out, as it is faster there."""
    import regex

    white = pattern.replace(r"[^\s", f"[^{_WHITE}").replace(r"\s", f"[{_WHITE}]").replace(r"\S", f"[^{_WHITE}]")
    parts, inside = [], False
    for piece in re.split(r"(\\p\{\w+\}|\\.|[\[\]])", white):
        if piece.startswith("\\p{"):
            piece = _ranges(piece[3:-1]) if inside else f"[{_ranges(piece[3:-1])}]"
        elif piece in ("[", "]"):
            inside = piece == "["
        parts.append(piece)
    usual, whole, high = re.compile("".join(parts)).findall, regex.compile(white).findall, re.compile("[\U00010000-\U0010ffff]").search
    return lambda text: whole(text) if high(text) else usual(text)


_ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))


@functools.lru_cache(1)
def _classes() -> np.ndarray:
    """Of each code point whether it is a letter (1), a number (2), white space (3) or none of these."""
    import regex

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every, place = "".join(map(chr, points)), np.array(points)
    out = np.zeros(0x110000, np.uint8)
    for kind, name in ((1, r"\p{L}"), (2, r"\p{N}"), (3, f"[{_WHITE}]")):
        for m in regex.finditer(f"{name}+", every):
            out[place[m.start() : m.end()]] = kind
    return out


def _word_starts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the words of ``PATTERN`` begin in the texts ``buf[offsets[i]:offsets[i+1]]`` (UTF-8, offsets from 0). A long text is looked at in stretches that begin with a space after an ASCII letter or digit."""
    out, lo = [], 0
    while lo < len(buf):
        hi = len(buf)
        for at in range(lo + LOOKED, len(buf) - LOOKED, LOOKED):
            cuts = np.flatnonzero((buf[at : at + LOOKED] == 0x20) & _ALNUM[buf[at - 1 : at + LOOKED - 1]])
            if len(cuts):
                hi = at + int(cuts[0])
                break
        out.append(lo + _starts_in(buf[lo:hi], np.unique(np.clip(offsets, lo, hi)) - lo))
        lo = hi
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _starts_in(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The same for one stretch.

    A word is a run of characters of one class. The last of some white space goes with what follows it if it is a space, and is a word of its own if it is not. An
    apostrophe that begins a word goes with some endings.
    """
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    codes = np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), np.uint32)
    kind, n = _classes()[codes], len(codes)
    begins = np.zeros(n, bool)
    begins[np.searchsorted(at, offsets[:-1][np.diff(offsets) > 0])] = True
    change = begins.copy()
    change[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(change)
    end = np.append(run[1:], n)
    goes_on = np.append(~begins[run[1:]], False)[: len(run)]  # another run of the same text follows
    start = np.zeros(n + 1, bool)
    start[run] = True
    white = end[(kind[run] == 3) & goes_on]
    start[white - 1] = True
    start[white[codes[white - 1] == 0x20]] = False
    # 's 't 'm 'd 're 've 'll
    size = np.append(end - run, 0)
    some = np.flatnonzero((codes[run] == 0x27) & (size[:-1] == 1) & goes_on & start[run])
    some = some[kind[run[some] + 1] == 1]
    p, letters = run[some], size[some + 1]
    one, two = codes[p + 1], codes[np.minimum(p + 2, n - 1)] * (letters > 1)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    start[p[short | long] + 1] = False
    start[p[short & (letters > 1)] + 2] = True
    start[p[long & (letters > 2)] + 3] = True
    return at[np.flatnonzero(start[:n])]


def word_hashes(buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``buf[bounds[i]:bounds[i+1]]``, a stretch of ``HASHED`` bytes at a time; a longer word is hashed by another function."""
    out, at, n = np.empty(len(bounds) - 1, np.uint64), 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + HASHED, "right")) - 1)
        lo, hi = int(bounds[at]), int(bounds[to])
        if hi - lo > HASHED:
            out[at] = int.from_bytes(hashlib.blake2b(buf[lo:hi].tobytes(), digest_size=8).digest(), "little")
        else:
            own = bounds[at : to + 1] - lo
            out[at:to] = span_hashes(buf[lo:hi], own[:-1], own[1:])
        at = to
    return out


class Words:
    """The words of a column of texts: word i is ``buf[bounds[i]:bounds[i+1]]``, those of text t are first[t]:first[t+1]."""

    def __init__(self, texts: pa.Array, pattern: str):
        buf, offsets = text_buffers(texts)
        base = int(offsets[0])
        self.buf, offsets = buf[base : int(offsets[-1])], offsets - base
        if pattern == PATTERN:
            starts = _word_starts(self.buf, offsets)
            self.first = np.searchsorted(starts, offsets)
            self.bounds = np.append(starts, len(self.buf))
        else:  # one text after the other, by the pattern
            find = word_finder(pattern)
            found = [[w.encode() for w in find(t)] if t else [] for t in texts.to_pylist()]
            self.first = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)
            words = [w for f in found for w in f]
            self.buf = np.frombuffer(b"".join(words), np.uint8)
            self.bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)

    def bytes_of(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of those words one after the other."""
        lo, hi = self.bounds[some], self.bounds[some + 1]
        ends = np.concatenate([[0], np.cumsum(hi - lo)])
        return self.buf[np.repeat(lo - ends[:-1], hi - lo) + np.arange(ends[-1])], ends


def pair_ranks(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """The rank of each pair of tokens whose concatenation is a token."""
    return {(ranks[t[:i]], ranks[t[i:]]): r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}


def _prime(n: int) -> int:
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


class PairTable:
    """Perfect hash of pairs of tokens with ids of ``bits`` bits: ``slots[(key * factor + shift[key % m]) % n]`` holds key * 2^bits + rank, so that it differs from key * 2^bits by a rank only where the pair is in the map."""

    EMPTY = 1 << 60

    def __init__(self, pairs: dict[tuple[int, int], int], bits: int = 16):
        if bits > MOST_BITS:
            raise ValueError(f"token ids of {bits} bits: {MOST_BITS} at most")
        self.bits, self.factor = bits, 0x2545F491 >> 2 * (bits - 16) | 1  # the product with a key stays below 2^63
        self.n = _prime(max(int(len(pairs) * 1.35), 1 << 17))
        self.m = _prime(max(len(pairs) // 3, 1 << 16, (1 << 2 * bits) // self.n + 1))  # m * n is over 2^(2 * bits), so no two keys of a bucket share a slot
        buckets: dict[int, list] = {}
        for (x, y), r in pairs.items():
            buckets.setdefault((x << bits | y) % self.m, []).append((x << bits | y, r))
        self.shift, self.slots = [0] * self.m, [self.EMPTY] * self.n
        tries = np.random.default_rng(3)
        for at, rows in sorted(buckets.items(), key=lambda b: -len(b[1])):
            base = [k * self.factor % self.n for k, _ in rows]
            while True:
                d = int(tries.integers(self.n))
                where = [(b + d) % self.n for b in base]
                if all(self.slots[w] == self.EMPTY for w in where):
                    break
            self.shift[at] = d
            for w, (k, r) in zip(where, rows, strict=True):
                self.slots[w] = k << bits | r


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_merges(bytes_: Column, byte_ids: list[int], table: PairTable) -> Column:
    """Token ids (array of bigint) of a word given as an array of its bytes.

    The state is one array; a part is rank * 2^high + place * 2^bits + id, where rank is that of the part with the next one and place its first byte. So the least
    element is the leftmost pair of least rank, and a step changes two elements and drops one.
    """
    bits, top, high = table.bits, 1 << table.bits, 62 - table.bits
    literal = lambda xs: F.split(F.lit(" ".join(map(str, xs))), " ").cast("array<bigint>")
    whole = F.struct(literal(byte_ids).alias("b"), literal(table.shift).alias("d"), literal(table.slots).alias("s"))

    def encode(t: Column) -> Column:
        def rank(x: Column, y: Column) -> Column:
            """The rank of the pair times 2^high, NONE if it has none; null without a y."""
            key = x * top + y
            entry = F.get(t["s"], F.pmod(key * table.factor + F.get(t["d"], F.pmod(key, F.lit(table.m))), F.lit(table.n))).bitwiseXOR(F.shiftleft(key, bits))
            return F.shiftleft(F.least(entry, F.lit(top)), high)

        def part(x: Column) -> Column:
            return x.bitwiseAND(F.lit(top - 1))

        def step(v: Column, _: Column) -> Column:
            least = F.array_min(v)
            at = F.struct(F.array_position(v, least).cast("int").alias("i"), F.shiftright(least, high).alias("m"), least.bitwiseAND(F.lit((1 << high) - top)).alias("p"))

            def merge(z: Column) -> Column:
                i, m = z["i"], z["m"]
                none = F.array().cast("array<bigint>")
                before = F.get(v, i - 2)
                left = F.when(i > 1, F.array(rank(part(before), m) + before.bitwiseAND(F.lit((1 << high) - 1)))).otherwise(none)
                own = F.array(F.coalesce(rank(m, part(F.get(v, i + 1))), F.lit(NONE)) + z["p"] + m)
                return F.concat(F.slice(v, F.lit(1), F.greatest(i - 2, F.lit(0))), left, own, F.slice(v, i + 2, F.size(v)))

            return F.when(least < NONE, _let(at, merge)).otherwise(v)

        def start(ids: Column) -> Column:
            return F.transform(ids, lambda x, j: F.coalesce(rank(x, F.get(ids, j + 1)), F.lit(NONE)) + F.shiftleft(j.cast("bigint"), bits) + x)

        ids = F.transform(bytes_, lambda b: F.get(t["b"], b))
        steps = F.when(F.size(bytes_) > 1, F.sequence(F.lit(2), F.size(bytes_))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, _let(ids, start), step, lambda v: F.transform(v, part))

    return _let(whole, encode)


class Encoder:
    """What the stages share: the bytes of the vocabulary file, and the expression that encodes the byte array of a word."""

    def __init__(self, path: str, pattern: str):
        self.pattern, self.file = pattern, _file(path)
        self.ranks = ranks = parse_ranks(self.file)
        self.table = PairTable(pair_ranks(ranks), max(16, max(ranks.values()).bit_length()))
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]

    def fold(self, column: Column) -> Column:
        return fold_merges(column, self.byte_ids, self.table)


@contextlib.contextmanager
def _short_plans(spark):
    """Meanwhile Spark keeps no plans with the megabytes of the literal as text."""
    key = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "4096")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def merge_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word in time linear in its length but for a logarithm: pairs of neighbours wait in a heap by rank and place."""
    n = len(word)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1") * n
    waiting: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        m = end[i]
        if m < n and (r := ranks.get(word[i : end[m]])) is not None:
            heapq.heappush(waiting, (r, i, m, end[m]))

    for i in range(n):
        offer(i)
    while waiting:
        _, i, m, e = heapq.heappop(waiting)
        if alive[i] and end[i] == m and alive[m] and end[m] == e:
            end[i], alive[m] = e, 0
            if e < n:
                before[e] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def _byte_arrays(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(data.astype(np.int16)))


def _token_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ascending, and ids) of the tokens."""
    tokens = list(ranks)
    ends = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
    hashes = span_hashes(np.frombuffer(b"".join(tokens), np.uint8), ends[:-1], ends[1:])
    order = np.argsort(hashes)
    return hashes[order], np.array([ranks[t] for t in tokens], np.uint32)[order]


def _there(table: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in the ascending ``table``, whether it has them) of hashes."""
    if not len(table):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return at, table[at] == hashes


def _dictionary(texts: DataFrame, encoder: Encoder, file, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, begins, sizes, ids): ascending hashes of the tokens and of frequent other words, and where their ids are; a threshold on their counts keeps the latter within ``most``.

    Tasks count words in batches; those that stand once in the whole corpus are left out.
    """
    pattern = encoder.pattern

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, _ = _token_table(parse_ranks(file.value))
        held: list[tuple] = []  # hashes, counts and spelling of the distinct words of some texts

        def out():
            hashes, counts = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            spelled = pa.concat_arrays([h[2] for h in held])
            held.clear()
            _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
            n = np.bincount(back, weights=counts).astype(np.int64)
            for lo in range(0, len(first), 20_000):
                yield pa.RecordBatch.from_arrays([spelled.take(pa.array(first[lo : lo + 20_000])), pa.array(n[lo : lo + 20_000])], names=["word", "n"])

        for b in pieces(batches, "text", LOOKED):
            w = Words(b.column(0), pattern)
            hashes, first, counts = np.unique(word_hashes(w.buf, w.bounds), return_index=True, return_counts=True)
            other = np.flatnonzero(~_there(tokens, hashes)[1] & (w.bounds[first + 1] - w.bounds[first] <= LONG))
            data, ends = w.bytes_of(first[other])
            held.append((hashes[other], counts[other], pa.Array.from_buffers(pa.string(), len(other), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])))
            if sum(len(h[0]) for h in held) > COUNTED:
                yield from out()
        if held:
            yield from out()

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, ends = text_buffers(b.column(0))
            data, ends = buf[int(ends[0]) : int(ends[-1])], ends - ends[0]
            yield pa.RecordBatch.from_arrays([pa.array(word_hashes(data, ends).view(np.int64)), _byte_arrays(data, ends)], names=["word", "bytes"])

    counted = texts.mapInArrow(tidy(count), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = cut(counted.where("n > 1"))  # a word that stands once is folded once anyway
    step = F.floor(F.log2("n") * 8).cast("int")
    total, least = 0, 0
    for r in counts.groupBy(step.alias("k")).agg(F.count("*").alias("c")).orderBy(F.desc("k")).collect():
        total += r.c
        if total > most:
            least = r.k + 1
            break
    spelled = counts.where(step >= least).select("word").repartition(texts.sparkSession.sparkContext.defaultParallelism * 4, "word")
    folded = spelled.mapInArrow(tidy(spell), "word long, bytes array<smallint>").select("word", encoder.fold(F.col("bytes")).cast("array<int>").alias("ids"))
    with _short_plans(texts.sparkSession):
        folded = cut(folded)
    rows = folded.toArrow()
    drop(counts, folded)
    # The driver holds each array once, narrow, and makes none of a place for each id.
    hashes = rows.column("word").to_numpy().view(np.uint64)
    lists = rows.column("ids").combine_chunks()
    del rows
    begins, flat = lists.offsets.to_numpy(), lists.values.to_numpy().astype(np.uint16 if encoder.table.bits == 16 else np.uint32)
    size = np.diff(begins).astype(np.uint16)
    tokens, token_ids = _token_table(encoder.ranks)
    hashes, size = np.concatenate([hashes, tokens]), np.concatenate([size, np.ones(len(tokens), np.uint16)])
    begins = np.concatenate([begins[:-1], len(flat) + np.arange(len(tokens), dtype=np.int32)])
    flat = np.concatenate([flat, token_ids.astype(flat.dtype)])
    del lists
    order = np.argsort(hashes)
    found = hashes[order], begins[order], size[order], flat
    del hashes, begins, size, order
    give_back()
    return found


def _within(size: np.ndarray) -> np.ndarray:
    """0, 1 .. size[0]-1, 0, 1 .. size[1]-1 and so on."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def encode(docs: DataFrame, path: str, pattern: str, words: int = WORDS, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` (doc_id, text and whatever else it has) with ``ids``, the token ids as little-endian unsigned 32-bit integers (binary).

    A null text encodes as an empty one, to no ids. Special tokens are ordinary text. Every row is encoded, repeated ones too; columns (all, or those in ``keep``)
    keep their names and values unless one is called ids, which is replaced. Texts and words of any length are taken whole. Token ids are below 2^MOST_BITS.
    """
    encoder = _encoder(path, pattern)
    spark = docs.sparkSession
    file = share(spark, encoder.file)
    kept = docs.columns if keep is None else keep
    text = F.col("`text`")
    give_back_driver(spark)  # what earlier steps of a long session left would add to the dictionary and to plans that hold the literal
    frequent = share(spark, _dictionary(docs.select(text), encoder, file, words))
    give_back_driver(spark)
    rows = wrapped(docs, text.alias("text"), keep=kept)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = parse_ranks(file.value)
        table, begins, sizes, flat = frequent.value
        for b in pieces(batches, "text", LOOKED):
            w = Words(b.column(1), pattern)
            hashes, first, which = np.unique(word_hashes(w.buf, w.bounds), return_index=True, return_inverse=True)
            at, there = _there(table, hashes)
            size = np.where(there, sizes[at], 2).astype(np.int64)  # two places stand for a word that is left to fold: MISS and its number
            long = {k: np.array(merge_heap(w.buf[w.bounds[first[k]] : w.bounds[first[k] + 1]].tobytes(), ranks), "<u4") for k in np.flatnonzero(~there & (w.bounds[first + 1] - w.bounds[first] > LONG)).tolist()}
            for k, own in long.items():
                size[k] = len(own)
            ends = np.concatenate([[0], np.cumsum(size)])
            code = np.empty(ends[-1], "<u4")
            known = np.flatnonzero(there)
            code[np.repeat(ends[known], size[known]) + _within(size[known])] = flat[np.repeat(begins[at[known]], size[known]) + _within(size[known])]
            left = np.setdiff1d(np.flatnonzero(~there), list(long))
            code[ends[left]], code[ends[left] + 1] = MISS, np.arange(len(left))
            for k, own in long.items():
                code[ends[k] : ends[k + 1]] = own
            size = size[which]  # of each word of the texts
            stops = np.concatenate([[0], np.cumsum(size)])
            ids = code[np.repeat(ends[which], size) + _within(size)]
            stops = stops[w.first]
            # Words to fold are numbered anew within each text.
            at = np.flatnonzero(ids == MISS)
            text, most = np.searchsorted(stops, at, "right") - 1, max(len(left), 1)
            pairs, back = np.unique(text * most + ids[at + 1], return_inverse=True)
            begin = np.searchsorted(pairs, np.arange(b.num_rows + 1) * most)
            ids[at + 1] = back - begin[text]
            missing = _byte_arrays(*w.bytes_of(first[left[pairs % most]] if len(left) else np.zeros(0, np.int64)))
            ids = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer((4 * stops).astype(np.int32)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([b.column(0), ids, pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), missing)], names=["row", "ids", "missing"])

    def fill_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for raw, lists in zip(b.column(1), b.column(2), strict=True):
                raw = raw.as_py()
                if len(lists):
                    code = np.frombuffer(raw, "<u4")
                    at = np.flatnonzero(code == MISS)
                    inner = lists.values
                    flat, ends = inner.flatten().to_numpy().astype("<u4"), inner.offsets.to_numpy() - inner.offsets[0].as_py()
                    which = code[at + 1]
                    take = np.ones(len(code), np.int64)
                    take[at] = ends[which + 1] - ends[which]
                    take[at + 1] = 0
                    new = np.repeat(code, take)
                    start = np.concatenate([[0], np.cumsum(take)])[at]
                    size = take[at]
                    place = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                    source = np.repeat(ends[which] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                    new[place] = flat[source]
                    raw = new.tobytes()
                out.append(raw)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["row", "ids"])

    row = rows.schema["row"].dataType.simpleString()
    looked = rows.mapInArrow(tidy(look_up), f"row {row}, ids binary, missing array<array<smallint>>")
    with _short_plans(spark):
        done = cut(looked.withColumn("missing", F.transform("missing", encoder.fold)).mapInArrow(tidy(fill_in), f"row {row}, ids binary"))
    file.destroy()  # nothing computes the written rows again
    frequent.destroy()
    return unwrapped(done, kept, ids=F.col("ids"))


_encoder = functools.lru_cache(2)(Encoder)


def _text(token: bytes) -> str | None:
    try:
        return token.decode()
    except UnicodeDecodeError:
        return None


def decoder(ranks: dict[bytes, int]):
    """A function from ids (binary) to bytes: the concatenated pieces."""
    pieces_ = [b""] * (max(ranks.values()) + 1)
    for token, r in ranks.items():
        pieces_[r] = token
    get = pieces_.__getitem__
    return lambda raw: b"".join(map(get, np.frombuffer(raw, "<u4").tolist()))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded`` (binary), the bytes that its ``ids`` stand for; null ids decode to nothing. A column called decoded is replaced."""
    file = share(encoded.sparkSession, _file(path))
    rows = wrapped(encoded, F.col("`ids`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = decoder(parse_ranks(file.value))
        for b in pieces(batches, "ids"):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([one(x or b"") for x in b.column(1).to_pylist()], pa.binary())], names=["row", "decoded"])

    return unwrapped(rows.mapInArrow(tidy(run), f"row {rows.schema['row'].dataType.simpleString()}, decoded binary"), encoded.columns, decoded=F.col("decoded"))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 and decoded_sha256 of its ids and of the bytes they decode to."""
    both = decode(encode(docs, path, pattern, keep=["doc_id"]), path)
    return both.select("doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
