"""Sinks: feature table, run metadata, flat waveform with its sidecar."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterator
from dataclasses import asdict, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tremor.config import Config
from tremor.functions.columns import arrays
from tremor.functions.kernels import COMPONENTS
from tremor.plans.planning import clocked
from tremor.shared import written
from tremor.stores import store_of

log = logging.getLogger("tremor")

#: Samples of a part of a waveform.
PART = 1 << 22


def write_features(table: DataFrame, out_dir: str, stem: str, cfg: Config, fs: float) -> str:
    """``<stem>_features.parquet`` (zstd, NaN as null) and ``<stem>_features.run_metadata.json`` with the actual output rate. Returns the table's path."""
    path = f"{out_dir}/{stem}_features.parquet"
    doubles = {c for c, k in table.dtypes if k == "double"}
    clean = [F.when(~F.isnan(c), F.col(c)).alias(c) if c in doubles else F.col(c) for c in table.columns if c != "station"]
    table.select(*clean).write.mode("overwrite").option("compression", "zstd").parquet(path)
    write_text(table, f"{out_dir}/{stem}_features.run_metadata.json", json.dumps(asdict(replace(cfg, fs=fs)), indent=2))
    return path


def write_text(like: DataFrame, path: str, text: str) -> None:
    """A small file through Hadoop's file system, so that the folder may be in any store."""
    spark = like.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


class Part(WriterCommitMessage):
    """A file that a task has written: its name, and the sample that it begins with."""

    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


class WaveformWriter(DataSourceArrowWriter):
    """Rows (sample_offset, e, n, z) as flat files, E N Z E N Z .. in little-endian float32, a file for each stretch of samples that a task brings in order.

    Tasks write aside. The commit takes the place of an earlier waveform in the folder; an aborted write, or a task that was tried twice, leaves nothing. The names of the parts
    sort in the order of their samples, so their concatenation is the whole waveform.
    """

    def __init__(self, path: str):
        if store_of(path) is None:
            raise ValueError(f"no file system of Arrow's reaches {path}")
        self.path, self.aside = path.rstrip("/"), f"{path.rstrip('/')}/_writing-{uuid.uuid4().hex}"

    def _store(self):
        store, prefix = store_of(self.path)
        return store, self.path.removeprefix(prefix), self.aside.removeprefix(prefix)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Part:
        store, _, aside = self._store()
        store.create_dir(aside, recursive=True)
        task, files, out, following = TaskContext.get(), [], None, None
        for b in batches:
            for offset, *x in zip(b.column(0).to_pylist(), *(arrays(c) for c in b.columns[1:]), strict=True):
                if offset != following:
                    if out:
                        out.close()
                    files.append((f"{aside}/{task.partitionId()}-{task.taskAttemptId()}-{len(files)}", offset))
                    out = store.open_output_stream(files[-1][0])
                data = interleaved(*x)
                out.write(data)
                following = offset + len(data) // 12
        if out:
            out.close()
        return Part(files)

    def commit(self, messages: list[Part]) -> None:
        from pyarrow import fs

        store, path, aside = self._store()
        for old in store.get_file_info(fs.FileSelector(path)):
            if old.base_name.startswith("part-"):
                store.delete_file(old.path)
        for m in messages:
            for name, offset in m.files if m else []:
                store.move(name, f"{path}/part-{offset:020d}.f32")
        store.delete_dir(aside)

    def abort(self, messages: list[Part]) -> None:
        from pyarrow import fs

        store, _, aside = self._store()
        if store.get_file_info(aside).type != fs.FileType.NotFound:
            store.delete_dir(aside)


class WaveformSink(DataSource):
    """``rows.write.format("f32").mode("append").save(path)`` with rows (sample_offset bigint, e, n, z array<double>), in order within partitions."""

    @classmethod
    def name(cls) -> str:
        return "f32"

    def writer(self, schema, overwrite: bool) -> WaveformWriter:
        return WaveformWriter(self.options["path"])


def interleaved(*components: np.ndarray) -> bytes:
    """E N Z E N Z .. as little-endian float32, up to the shortest component."""
    n = min(map(len, components))
    return np.stack([x[:n] for x in components], axis=1).astype("<f4").tobytes()


def write_waveform(blocks: DataFrame, chunks: DataFrame, path: str, cfg: Config, sidecar_path: str | None = None, note: str = "sample i lies at start_epoch + (i - sample_offset) / fs of the last segment that begins at or before it") -> dict:
    """The waveform of one station as parts in the folder ``path``, written by the tasks that hold it, and its sidecar, ``path``.json unless named; returns the sidecar.

    ``blocks``: CHUNK; ``chunks``: station, segment, block, start_epoch, fs and len of those, from which every block's place in the waveform is known before it is computed.
    """
    spark = blocks.sparkSession
    spark.dataSource.register(WaveformSink)
    places = written(clocked(chunks, 0.5, True), "waveform-places")
    parts = places.where("begins").orderBy("sample_offset").select("sample_offset", "start_epoch").collect()
    facts = places.agg(F.sum("len").alias("samples"), F.max("fs").alias("fs")).first()
    samples, counts = int(facts.samples or 0), dict.fromkeys("enz", 0)
    if samples:
        rows, seen = blocks.join(places.select("station", "segment", "block", "sample_offset"), ["station", "segment", "block"]), Observation()
        short = F.least(*[F.size(c) for c in "enz"])
        missing = [F.sum(F.size(F.filter(F.slice(c, F.lit(1), short), lambda v: v.isNull() | F.isnan(v)))).alias(c) for c in "enz"]
        # Parts are stretches of the waveform that are known beforehand, so blocks are computed once and no range is sampled.
        ready = rows.select("sample_offset", "e", "n", "z", F.floor(F.col("sample_offset") / PART).alias("part")).observe(seen, *missing).repartition("part").sortWithinPartitions("sample_offset")
        ready.drop("part").write.format("f32").mode("append").save(path)
        counts = seen.get
    else:
        log.warning("no samples for %s", path)
    sidecar = {
        "format": "f32le", "layout": "interleaved", "channels": list(COMPONENTS), "dtype": "<f4", "samples": samples, "shape": [samples, 3], "fs": float(facts.fs or 0), "nan_counts": {c: int(counts[c.lower()] or 0) for c in COMPONENTS},
        "freqmin": cfg.freqmin, "freqmax": cfg.freqmax, "station": cfg.station, "segments": [{"sample_offset": r.sample_offset, "start_epoch": r.start_epoch} for r in parts], "note": note,
    }
    write_text(blocks, sidecar_path or f"{path}.json", json.dumps(sidecar, indent=2))
    return sidecar


def join_parts(spark, folder: str, path: str) -> None:
    """One flat file of the parts in ``folder``, copied stream by stream by the file system's own client; only where a reader needs a single file."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = hadoop.fs.Path(f"{folder}/part-*.f32"), hadoop.fs.Path(path)
    store = source.getFileSystem(conf)
    out = target.getFileSystem(conf).create(target, True)
    try:
        for part in sorted((f.getPath() for f in store.globStatus(source) or []), key=lambda p: p.getName()):
            own = store.open(part)
            try:
                hadoop.io.IOUtils.copyBytes(own, out, 1 << 20, False)
            finally:
                own.close()
    finally:
        out.close()
