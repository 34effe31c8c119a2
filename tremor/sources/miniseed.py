"""miniSEED records, versions 2 and 3, from the public format description, as a Spark source.

A file is read by ranges of bytes, many tasks a file: a range owns the records that begin in it, and finds the first of them by a header that two more valid ones follow. Records are
reached by positioned reads, so an index costs little more than its headers, and payloads of records that filters leave out are never read.

``read_records`` lists files and their sizes with Spark. Folders that Arrow's file systems reach (local, S3, GCS, HDFS) are read by ranges; others whole, through
Spark's binary file reader. The data source ``miniseed`` does the same for a folder that Arrow reaches, and takes filters on component and start_epoch.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from tremor.stores import store_of

SCHEMA = "path string, offset bigint, len int, sid string, component string, start_epoch double, count int, fs double"
WITH_SAMPLES = SCHEMA + ", samples array<double>"
#: Bytes that a header may take; a tail shorter than 64 bytes at the end of a file is ignored.
HEAD, LEAST = 128, 64
_DAYS = [(y - 1970) * 365 + sum((k % 4 == 0 and k % 100 != 0) or k % 400 == 0 for k in range(1970, y)) if y >= 1970 else (y - 1970) * 365 for y in range(0, 3000)]


class FormatError(ValueError):
    """Bytes that are no miniSEED record, or one that can't be read."""


def component_of(sid: str) -> str | None:
    """E, N or Z by the first letter of the last part of a source id; 1 is E and 2 is N. None for any other."""
    tail = re.split(r"[_.]", sid)[-1][:1].upper()
    return {"Z": "Z", "N": "N", "2": "N", "E": "E", "1": "E"}.get(tail)


def _epoch(year: int, day: int, hour: int, minute: int, second: int, nanos: int) -> float:
    return (_DAYS[year] + day - 1) * 86400 + hour * 3600 + minute * 60 + second + nanos / 1e9


def _rate(factor: int, multiplier: int) -> float:
    if not factor or not multiplier:
        return 0.0
    a = factor if factor > 0 else -1 / factor
    return a * multiplier if multiplier > 0 else -a / multiplier


def parse_header(data: memoryview | bytes, at: int) -> dict:
    """Fields of the record at ``at``, with data_at, encoding and order for its samples."""
    head = bytes(data[at : at + HEAD])
    if head[:2] == b"MS" and head[2] == 3:
        nanos, year, day, hour, minute, second, encoding, rate, count = struct.unpack_from("<IHHBBBBdI", head, 4)
        sid_n, extra_n, data_n = struct.unpack_from("<BHI", head, 33)
        sid = bytes(data[at + 40 : at + 40 + sid_n]).decode("ascii", "replace")
        start = _epoch(year, day, hour, minute, second, nanos)
        return {"len": 40 + sid_n + extra_n + data_n, "sid": sid, "start_epoch": start, "count": count, "fs": rate if rate >= 0 else -1 / rate, "encoding": encoding, "order": "<" if encoding < 10 else ">", "data_at": at + 40 + sid_n + extra_n}
    if not (re.match(rb"[0-9 \0]{6}[DRQM][ \0]", head) and len(head) >= 48):
        raise FormatError(f"Not miniSEED at byte {at}")
    order = ">" if 1900 <= struct.unpack_from(">H", head, 20)[0] <= 2100 else "<"
    station, location, channel, network = (head[a:b].decode("ascii", "replace").strip() for a, b in ((8, 13), (13, 15), (15, 18), (18, 20)))
    year, day, hour, minute, second, tenths, count, factor, multiplier, activity, _, _, blockettes, correction, data_at, next_ = struct.unpack_from(order + "HHBBBxHHhhBBBBiHH", head, 20)
    rate, encoding, length, micros, data_order = _rate(factor, multiplier), None, None, 0, order
    for _ in range(blockettes):
        if not next_ or next_ + 8 > len(head):
            break
        kind, following = struct.unpack_from(order + "HH", head, next_)
        if kind == 1000:
            encoding, big, power = head[next_ + 4], head[next_ + 5], head[next_ + 6]
            data_order, length = ">" if big else "<", 1 << power
        elif kind == 1001:
            micros = struct.unpack_from("b", head, next_ + 5)[0]
        elif kind == 100:
            rate = struct.unpack_from(order + "f", head, next_ + 4)[0]
        next_ = following
    if length is None:
        raise FormatError(f"Unknown record length at byte {at}")
    start = _epoch(year, day, hour, minute, second, tenths * 100_000 + micros * 1000)
    if correction and not activity & 2:
        start += correction / 1e4
    sid = f"FDSN:{network}_{station}_{location}_" + "_".join(channel)
    return {"len": length, "sid": sid, "start_epoch": start, "count": count, "fs": rate, "encoding": encoding, "order": data_order, "data_at": at + data_at}


_PLAIN = {1: "i2", 3: "i4", 4: "f4", 5: "f8"}


def _split(words: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """Signed fields of ``bits`` bits, the last in the lowest bits of its word."""
    shift = np.arange(parts - 1, -1, -1) * bits
    v = (words[:, None].astype(np.int64) >> shift) & ((1 << bits) - 1)
    return np.where(v >= 1 << (bits - 1), v - (1 << bits), v)


def unsteim_many(parts: list[bytes], counts: np.ndarray, order: str, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(samples of all records one after the other, how many each has) from the Steim 1 or 2 frames of many records: all differences of a kind are unpacked at once, then summed by record."""
    frames = np.array([len(p) // 64 for p in parts], np.int64)
    words = np.frombuffer(b"".join(p[: 64 * n] for p, n in zip(parts, frames, strict=True)), order + "u4").astype(np.int64).reshape(-1, 16)
    begins = (np.cumsum(frames) - frames)[frames > 0]
    kind = (words[:, :1] >> np.arange(30, -2, -2)) & 3
    first = words[begins, 1].astype(np.uint32).view(np.int32).astype(np.int64)
    kind[begins, 1:3] = 0
    kind[:, 0] = 0
    words, kind = words.ravel(), kind.ravel()
    sub = words >> 30
    shapes = [((kind == 1), 8, 4)]
    if level == 1:
        shapes += [(kind == 2, 16, 2), (kind == 3, 32, 1)]
    else:
        shapes += [((kind == 2) & (sub == k), b, p) for k, b, p in ((1, 30, 1), (2, 15, 2), (3, 10, 3))]
        shapes += [((kind == 3) & (sub == k), b, p) for k, b, p in ((0, 6, 5), (1, 5, 6), (2, 4, 7))]
    size = np.zeros(len(words), np.int64)
    for mask, _, fields in shapes:
        size[mask] = fields
    ends = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(ends[-1]), np.int64)
    for mask, bits, fields in shapes:
        out[ends[:-1][mask][:, None] + np.arange(fields)] = _split(words[mask], bits, fields)
    lo = np.zeros(len(parts), np.int64)
    lo[frames > 0] = ends[begins * 16]
    held = np.diff(ends[np.concatenate([[0], np.cumsum(frames)]) * 16])  # differences of each record
    some = held > 0
    out[lo[some]] = first[some[frames > 0]]
    total = np.concatenate([[0], np.cumsum(out)])
    n = np.minimum(held, counts)
    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return (total[at + 1] - np.repeat(total[lo], n)).astype(float), n


def unsteim(data: bytes, count: int, order: str, level: int) -> np.ndarray:
    """Samples of the frames of one record."""
    return unsteim_many([data], np.array([count]), order, level)[0]


def decode_many(parts: list[bytes], headers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """(samples of all records one after the other as float64, how many each has), as many as its header counts or its data holds; ``parts`` are their payloads. Records of one coding are decoded at once."""
    values: list[np.ndarray] = [np.zeros(0)] * len(parts)
    kinds: dict[tuple, list[int]] = {}
    for k, h in enumerate(headers):
        kinds.setdefault((h["encoding"], h["order"]), []).append(k)
    for (encoding, order), which in kinds.items():
        counts = np.array([headers[k]["count"] for k in which], np.int64)
        if encoding in _PLAIN:
            kind = np.dtype(order + _PLAIN[encoding])
            n = np.minimum(counts, [len(parts[k]) // kind.itemsize for k in which])
            x = np.frombuffer(b"".join(parts[k][: m * kind.itemsize] for k, m in zip(which, n.tolist(), strict=True)), kind).astype(float)
        elif encoding in (10, 11):
            x, n = unsteim_many([parts[k] for k in which], counts, order, encoding - 9)
        else:
            raise FormatError(f"Unsupported sample type: encoding {encoding}")
        for k, own in zip(which, np.split(x, np.cumsum(n)[:-1]), strict=True):
            values[k] = own
    return np.concatenate(values) if values else np.zeros(0), np.array([len(v) for v in values], np.int64)


#: Bytes of a range of a file, bytes that are read at once where payloads are wanted, and records of a batch.
SPLIT, AHEAD, BATCH = 1 << 26, 1 << 18, 1024
#: Tasks that ranges are dealt out to at most; a task may have several.
MOST_TASKS = 100_000
#: Valid headers in a row that make a place within a file the beginning of a record.
CHAIN = 3
_BEGIN = re.compile(rb"[0-9 \0]{6}[DRQM][ \0]|MS\x03")


class Bytes:
    """Positioned reads of a file of ``size`` bytes; what one read brings ahead serves the next ones. ``taken`` counts the bytes that were read."""

    def __init__(self, read: Callable[[int, int], bytes], size: int, ahead: int = HEAD):
        self.read, self.size, self.ahead, self.taken = read, size, ahead, 0
        self.at, self.held = 0, b""

    def __call__(self, at: int, n: int) -> bytes:
        n = min(n, self.size - at)
        if n <= 0:
            return b""
        if not (self.at <= at and at + n <= self.at + len(self.held)):
            self.at, self.held = at, self.read(at, min(max(n, self.ahead), self.size - at))
            self.taken += len(self.held)
        return self.held[at - self.at : at - self.at + n]


def _header(source: Bytes, at: int) -> dict:
    """The header at ``at``, with data_at within the record."""
    return parse_header(source(at, HEAD), 0)


def first_record(source: Bytes, lo: int, hi: int) -> int | None:
    """Where the first record begins that begins in lo..hi: a header that others follow; None if there is none."""
    if lo == 0:
        return 0
    at = lo
    while at < hi:
        window = source(at, 1 << 16)
        for m in _BEGIN.finditer(window):
            place = at + m.start()
            if place >= hi:
                return None
            try:
                following = place
                for _ in range(CHAIN):
                    if following + LEAST > source.size:
                        break
                    h = _header(source, following)
                    if h["len"] < 40 or h["encoding"] is None:
                        raise FormatError
                    following += h["len"]
                if following <= source.size:
                    return place
            except (FormatError, struct.error, IndexError):
                continue
        if len(window) < 1 << 16:
            return None
        at += len(window) - 8  # a beginning may lie across two windows
    return None


@dataclass(frozen=True)
class Wanted:
    """Which records are read: their components (None: all three), and the bounds of start_epoch, either of which may be strict."""

    components: frozenset[str] | None = None
    least: float = -np.inf
    most: float = np.inf
    above: float = -np.inf
    below: float = np.inf

    def __call__(self, component: str | None, h: dict) -> bool:
        if not (component and h["fs"] > 0 and h["count"] > 0 and (self.components is None or component in self.components)):
            return False
        return self.least <= h["start_epoch"] <= self.most and self.above < h["start_epoch"] < self.below


_KINDS = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.int32(), pa.float64()]
_NAMES = ["path", "offset", "len", "sid", "component", "start_epoch", "count", "fs"]


def batches(path: str, source: Bytes, lo: int, hi: int, samples: bool, wanted: Wanted) -> Iterator[pa.RecordBatch]:
    """Batches of SCHEMA (or WITH_SAMPLES) of the wanted records that begin in lo..hi. A tail of less than LEAST bytes is ignored."""
    rows: list[tuple] = []
    payloads: list[bytes] = []
    headers: list[dict] = []

    def out() -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)]
        if samples:
            values, n = decode_many(payloads, headers)
            columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(values)))
        return pa.RecordBatch.from_arrays(columns, names=_NAMES + ["samples"] * samples)

    at = first_record(source, lo, hi)
    while at is not None and at < hi and at + LEAST <= source.size:
        h = _header(source, at)
        component = component_of(h["sid"])
        if wanted(component, h):
            rows.append((path, at, h["len"], h["sid"], component, h["start_epoch"], h["count"], h["fs"]))
            if samples:
                payloads.append(source(at + h["data_at"], h["len"] - h["data_at"]))
                headers.append(h)
            if len(rows) == BATCH:
                yield out()
                rows, payloads, headers = [], [], []
        if h["len"] <= 0:
            raise FormatError(f"Record of length {h['len']} at byte {at} of {path}")
        at += h["len"]
    if rows:
        yield out()


def records(path: str, data: bytes, samples: bool) -> Iterator[tuple]:
    """Rows of SCHEMA (or WITH_SAMPLES) of a file's bytes."""
    source = Bytes(lambda at, n: data[at : at + n], len(data))
    for b in batches(path, source, 0, len(data), samples, Wanted()):
        columns = [c.to_pylist() for c in b.columns[:8]] + [[v.values.to_numpy() for v in b.column(8)]] * samples
        yield from zip(*columns, strict=True)


def opened(path: str, size: int, ahead: int) -> Bytes:
    store, prefix = store_of(path)
    f = store.open_input_file(path.removeprefix(prefix))
    return Bytes(lambda at, n: f.read_at(n, at), size, ahead)


def read_records(spark: SparkSession, path: str, samples: bool = False, split: int = SPLIT) -> DataFrame:
    """Records of the files directly in a folder."""
    kind = WITH_SAMPLES if samples else SCHEMA
    files = spark.read.format("binaryFile").load(path)
    if store_of(path) is None:

        def whole(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in rows:
                for p, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    data = content.as_buffer().to_pybytes()
                    yield from batches(p, Bytes(lambda at, n, d=data: d[at : at + n], len(data)), 0, len(data), samples, Wanted())

        return files.select("path", "content").mapInArrow(whole, kind)

    def ranges(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for p, size, lo in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield from batches(p, opened(p, size, AHEAD if samples else HEAD), lo, min(lo + split, size), samples, Wanted())

    # Sizes come without reading contents, which are not selected. The number of partitions is given, since rows of ranges are too small to be left to adaptive coalescing.
    sizes = files.select("path", "length").where("length > 0")
    ranges_in_all = sizes.agg(F.sum(F.ceil(F.col("length") / split))).first()[0] or 0
    dealt = sizes.select("path", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(split).cast("bigint"))).alias("lo"))
    return dealt.repartition(max(1, min(ranges_in_all, MOST_TASKS)), "path", "lo").mapInArrow(ranges, kind)


class RangePartition(InputPartition):
    def __init__(self, path: str, size: int, lo: int, hi: int):
        self.path, self.size, self.lo, self.hi = path, size, lo, hi


class MiniSeedReader(DataSourceReader):
    def __init__(self, options: dict, samples: bool):
        self.root, self.samples, self.wanted = options.get("path", ""), samples, Wanted()
        self.split = int(options.get("split", SPLIT))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        w = self.wanted
        own = lambda values: frozenset(values) & (w.components if w.components is not None else frozenset(values))
        for f in filters:
            name = getattr(f, "attribute", None)
            if isinstance(f, EqualTo) and name == ("component",):
                w = Wanted(own([f.value]), w.least, w.most, w.above, w.below)
            elif isinstance(f, In) and name == ("component",):
                w = Wanted(own(f.value), w.least, w.most, w.above, w.below)
            elif isinstance(f, GreaterThanOrEqual) and name == ("start_epoch",):
                w = Wanted(w.components, max(w.least, f.value), w.most, w.above, w.below)
            elif isinstance(f, LessThanOrEqual) and name == ("start_epoch",):
                w = Wanted(w.components, w.least, min(w.most, f.value), w.above, w.below)
            elif isinstance(f, GreaterThan) and name == ("start_epoch",):
                w = Wanted(w.components, w.least, w.most, max(w.above, f.value), w.below)
            elif isinstance(f, LessThan) and name == ("start_epoch",):
                w = Wanted(w.components, w.least, w.most, w.above, min(w.below, f.value))
            else:
                yield f
        self.wanted = w

    def partitions(self) -> list[RangePartition]:
        from pyarrow import fs

        found = store_of(self.root)
        if found is None:
            raise ValueError(f"{self.root} is in a store that only Spark reads: use read_records")
        store, prefix = found
        files = sorted((f.path, f.size) for f in store.get_file_info(fs.FileSelector(self.root.removeprefix(prefix))) if f.type == fs.FileType.File)
        if not files:
            raise FileNotFoundError(f"No files found in {self.root}")
        return [RangePartition(prefix + path, size, lo, min(lo + self.split, size)) for path, size in files for lo in range(0, max(size, 1), self.split)]

    def read(self, partition: RangePartition) -> Iterator[pa.RecordBatch]:
        narrow = self.wanted != Wanted(self.wanted.components)
        source = opened(partition.path, partition.size, AHEAD if self.samples and not narrow else HEAD)
        yield from batches(partition.path, source, partition.lo, partition.hi, self.samples, self.wanted)


class MiniSeedSource(DataSource):
    """``spark.read.format("miniseed").option("columns", "header")`` leaves samples undecoded; ``split`` is the number of bytes of a partition."""

    @classmethod
    def name(cls) -> str:
        return "miniseed"

    @property
    def _samples(self) -> bool:
        return self.options.get("columns", "samples") != "header"

    def schema(self) -> str:
        return WITH_SAMPLES if self._samples else SCHEMA

    def reader(self, schema) -> MiniSeedReader:
        return MiniSeedReader(self.options, self._samples)


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("miniseed")`` known, with filters on component and start_epoch passed to the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MiniSeedSource)
