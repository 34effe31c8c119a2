"""The two pipelines: records to blocks to features, and records to a conditioned waveform.

Headers are read once, into an index, from which ``planning`` derives where every sample goes and which window it is in. Samples are read once, and travel from the reader to
the task of their block, and from blocks to groups of windows. A group holds the samples of ``GROUP`` windows and is computed as one matrix.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.config import Config
from tremor.functions.columns import arrays, lists
from tremor.functions.kernels import COMPONENTS, FEATURES, features, power, zscore
from tremor.operators.assemble import check_index
from tremor.operators.condition import process
from tremor.operators.scan import differences
from tremor.plans.planning import chunks_of, plan_blocks, runs_of
from tremor.shared import written
from tremor.sources.miniseed import read_records

log = logging.getLogger("tremor")

GROUP = 64
#: Samples of a component in the windows that are computed as one matrix: groups may be small, and many.
MATRIX = 1 << 18
CHUNK = "station string, segment int, block int, start_epoch double, fs double, e array<double>, n array<double>, z array<double>"


def blocks_of(samples: DataFrame, plan: DataFrame, cfg: Config, native: float) -> DataFrame:
    """Conditioned blocks (CHUNK). Of samples on one place the last record's stands; places without one are missing (NaN), a whole block of them too."""
    factor, out_fs = cfg.decimation(native)

    def condition(pdf: pd.DataFrame) -> pd.DataFrame:
        b = pdf.iloc[0]
        lead, take = int(b.lead), int(b["take"])
        first = int(b["first"]) - lead
        grid = {c: np.full(lead + take, np.nan) for c in COMPONENTS}
        for r in pdf[pdf.path.notna()].sort_values(["start_epoch", "path", "offset"], kind="stable").itertuples():
            lo = int(r.place) - first
            a, z = max(0, -lo), min(len(r.samples), lead + take - lo)
            if z > a:
                grid[r.component][lo + a : lo + z] = r.samples[a:z]
        out = [process(grid[c], native, cfg.freqmin, cfg.freqmax, factor, lead + int(b.phase)) for c in COMPONENTS]
        return pd.DataFrame([[b.station, int(b.segment), int(b.block), float(b.start), out_fs, *out]], columns=["station", "segment", "block", "start_epoch", "fs", "e", "n", "z"])

    wanted = plan.where("block is not null")
    placed = wanted.where("path is not null").join(samples.select("path", "offset", "component", "samples"), ["path", "offset"])
    empty = wanted.where("path is null").withColumns({"component": F.lit(None).cast("string"), "samples": F.lit(None).cast("array<double>")})
    return placed.unionByName(empty).groupBy("station", "segment", "block").applyInPandas(condition, CHUNK)


@dataclass
class Archive:
    """An archive's plan, its conditioned blocks (CHUNK), what is known of them beforehand (station, segment, block, start_epoch, fs, len), its native and its output rate, and its late records."""

    plan: DataFrame
    blocks: DataFrame
    chunks: DataFrame
    native: float
    fs: float
    late: int


def archive(spark: SparkSession, path: str, cfg: Config, **seconds) -> Archive:
    """The archive of a folder. Raises if its rates differ or a component is missing; all stations of a folder are one, named in ``cfg``.

    Records that come too late for their block are left out and counted; they and an output rate that is not the one asked for are logged as warnings.
    """
    index = written(read_records(spark, path).withColumn("station", F.lit(cfg.station)), "index")
    facts = index.groupBy("component").agg(F.min("fs").alias("lo"), F.max("fs").alias("hi")).collect()
    if not facts:
        raise FileNotFoundError(f"No files found in {path}, or none with a record")
    native = check_index([v for r in facts for v in (r.lo, r.hi)], [r.component for r in facts])
    if problems := cfg.problems(native):
        raise ValueError("; ".join(problems))
    if warning := cfg.rate_warning(native):
        log.warning(warning)
    factor, fs = cfg.decimation(native)
    plan = plan_blocks(index, factor, **seconds)
    late = plan.where("block is null").count()
    if late:
        log.warning("%s records came too late for their block and were left out", late)
    return Archive(plan, blocks_of(read_records(spark, path, samples=True), plan, cfg, native), chunks_of(plan, factor, native), native, fs, late)


def window_features(pieces: DataFrame, win: int, step: int, nsta: int, nlta: int, standard_hjorth: bool = False, names: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """station, run, w, end_epoch and the features ``names``, all 51 if not told otherwise, of each full window. ``pieces``: station, run, pos, start_epoch, fs, e, n, z, of which none overlap."""
    return windows(pieces, win, step, lambda e, n, z, fs: features(e, n, z, fs, nsta, nlta, standard_hjorth, names), ", ".join(f"`{f}` double" for f in names))


def window_spectra(pieces: DataFrame, win: int, step: int) -> DataFrame:
    """station, run, w, end_epoch and E, N, Z, the power of the z-scored samples of each full window at the frequencies 0, fs / win, 2 fs / win and so on; NaN for a window with a missing sample."""
    spectra = lambda e, n, z, fs: {c: power(zscore(x)) for c, x in zip(COMPONENTS, (e, n, z), strict=True)}
    return windows(pieces, win, step, spectra, ", ".join(f"{c} array<double>" for c in COMPONENTS))


def windows(pieces: DataFrame, win: int, step: int, values: Callable[[np.ndarray, np.ndarray, np.ndarray, float], dict[str, np.ndarray]], schema: str) -> DataFrame:
    """station, run, w, end_epoch and the columns ``schema`` of each full window: ``values`` of matrices of windows (one row each) of the three components, and the rate.

    A piece is cut into the groups of windows that it overlaps, so a sample is sent little more than once however much the windows overlap.
    """
    kind = dict(pieces.dtypes)["station"]
    span = GROUP * step

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            station, run, pos, start, fs = (b.column(k) for k in range(5))
            run, pos, start, fs = (c.to_numpy() for c in (run, pos, start, fs))
            x = [arrays(b.column(k)) for k in (5, 6, 7)]
            n = np.max([[len(v) for v in c] for c in x], axis=0)
            # A piece is in the groups from that whose last window reaches its first sample to that which begins at or before its last one.
            first, last = np.maximum(0, (pos - win - span) // span + 1), np.where(n > 0, (pos + n - 1) // span, -1)
            rows = [(k, g, lo, hi) for k in range(len(n)) for g in range(int(first[k]), int(last[k]) + 1) if (hi := min(pos[k] + n[k], (g + 1) * span - step + win)) > (lo := max(pos[k], g * span))]
            which, group, lo, hi = (np.array(c, np.int64) for c in (zip(*rows, strict=True) if rows else ([], [], [], [])))
            parts = [lists([c[k][a - pos[k] : z - pos[k]] for k, a, z in zip(which, lo, hi, strict=True)]) for c in x]
            out = [station.take(pa.array(which)), pa.array(run[which]), pa.array(group), pa.array(lo), pa.array((start - pos / fs)[which]), pa.array(fs[which]), *parts]
            yield pa.RecordBatch.from_arrays(out, names=["station", "run", "g", "pos", "epoch", "fs", "e", "n", "z"])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []  # pieces of a group: pos, epoch, fs, and samples of three components

        ready, size, rate = [], 0, None  # (station, run, w, end, windows of three components) of whole groups of one rate

        def group():
            station, run, g = key
            lo = g * span
            n = max(p[0] + max(map(len, p[3:])) for p in held) - lo
            count = min(GROUP, (n - win) // step + 1) if n >= win else 0
            if count <= 0:
                return None
            x = np.full((3, max(n, (count - 1) * step + win)), np.nan)
            for p in held:
                for c in range(3):
                    x[c, p[0] - lo : p[0] - lo + len(p[3 + c])] = p[3 + c]
            views = [np.lib.stride_tricks.sliding_window_view(c, win)[::step][:count] for c in x]
            w = g * GROUP + np.arange(count)
            # The clock of a window is that of the piece its last sample lies in.
            at = np.clip(np.searchsorted([p[0] for p in held], w * step + win - 1, "right") - 1, 0, None)
            end = np.array([p[1] for p in held])[at] + (w * step + win) / held[0][2]
            return [station] * count, [run] * count, w, end, *views

        def flush():
            station, run, w, end, *x = zip(*ready, strict=True)
            x = [v[0] if len(v) == 1 else np.concatenate(v) for v in x]
            found = values(*x, rate)
            return pa.RecordBatch.from_arrays([pa.array(sum(station, []), kind_), pa.array(sum(run, []), pa.int64()), pa.array(np.concatenate(w)), pa.array(np.concatenate(end)), *(pa.array(v, from_pandas=True) if v.ndim == 1 else lists(list(v)) for v in found.values())], names=["station", "run", "w", "end_epoch", *found])

        for b in batches:
            kind_ = b.schema.field("station").type
            keys = zip(*(c.to_pylist() for c in b.columns[:3]), strict=True)
            facts = zip(*(c.to_pylist() for c in b.columns[3:6]), strict=True)
            for now, fact, *x in zip(keys, facts, *(arrays(c) for c in b.columns[6:]), strict=True):
                if now != key:
                    if held and (made := group()):
                        if ready and (rate != held[0][2] or size + len(made[2]) * win > MATRIX):
                            yield flush()
                            ready, size = [], 0
                        rate = held[0][2]
                        ready.append(made)
                        size += len(made[2]) * win
                    key, held = now, []
                held.append((*fact, *(v.copy() for v in x)))
        if held and (made := group()):
            if ready and rate != held[0][2]:
                yield flush()
                ready = []
            rate = held[0][2]
            ready.append(made)
        if ready:
            yield flush()

    groups = pieces.select("station", "run", "pos", "start_epoch", "fs", "e", "n", "z").mapInArrow(cut, f"station {kind}, run bigint, g bigint, pos bigint, epoch double, fs double, e array<double>, n array<double>, z array<double>")
    ordered = groups.repartition("station", "run", "g").sortWithinPartitions("station", "run", "g", "pos")
    return ordered.mapInArrow(compute, f"station {kind}, run bigint, w bigint, end_epoch double, {schema}")


def feature_table(found: DataFrame, runs: DataFrame, stem: str | None = None) -> DataFrame:
    """station and the 104 columns: label, time of the window's end in minutes, features, and their differences from the window before (also across pauses).

    Windows are numbered across the ``runs`` (station, run, windows_before) of a station, so no sort of its windows is needed.
    """
    named = found.join(runs.select("station", "run", "windows_before"), ["station", "run"]).withColumn("g", F.col("windows_before") + F.col("w"))
    label = F.concat(F.lit(stem) if stem else F.col("station").cast("string"), F.lit("_w"), F.format_string("%02d", F.col("g") + 1))
    steps = differences(named, ["station"], "g", FEATURES, "_DEV")
    return steps.select("station", label.alias("Pencere_ID"), (F.col("end_epoch") / 60).alias("Zaman_Dk"), *FEATURES, *[f"{f}_DEV" for f in FEATURES])


def extract(spark: SparkSession, path: str, cfg: Config, **seconds) -> tuple[DataFrame, Archive, int]:
    """(feature table of an archive folder, the archive, how many windows it has). Windows follow the clock of their run."""
    a = archive(spark, path, cfg, **seconds)
    nsta, nlta = cfg.average_lengths(a.fs)
    places, runs = runs_of(a.chunks, cfg.win_size, cfg.step_size)
    windows = int(runs.agg(F.sum("windows")).first()[0] or 0)
    if not windows:
        log.warning("no window of %s samples fits into the runs of %s", cfg.win_size, path)
    pieces = a.blocks.join(places, ["station", "segment", "block"]).withColumn("start_epoch", F.col("epoch") + F.col("pos") / F.col("fs"))
    return feature_table(window_features(pieces, cfg.win_size, cfg.step_size, nsta, nlta), runs, cfg.station), a, windows


def run(spark: SparkSession, path: str, cfg: Config) -> DataFrame:
    """Feature table of an archive folder."""
    return extract(spark, path, cfg)[0]
