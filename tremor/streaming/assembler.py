"""Streaming assembly: records in, conditioned blocks out.

A station's state is the few numbers of its planner, the records that wait for their turn, and the samples of its open block with the context before it. Records are
appended to lists that are read only when some of them can go on or a block closes. A timer of processing time drains a station that was left alone.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from dataclasses import fields

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tremor.config import Config
from tremor.functions.kernels import COMPONENTS
from tremor.operators.assemble import Block, Planner
from tremor.operators.condition import process
from tremor.plans.pipeline import CHUNK

_STORE = "spark.sql.streaming.stateStore.providerClass"
_CLOCK = "start double, watermark double, filled bigint, offset bigint, lead bigint, segment bigint, number bigint, dropped bigint, newest double, timer bigint"
_WAITING = "start_epoch double, path string, offset bigint, component string, samples array<double>"
_OPEN = "segment bigint, place bigint, component string, samples array<double>"
_NUMBERS = [c.split()[0] for c in _CLOCK.split(", ")][:8]
assert set(_NUMBERS) <= {f.name for f in fields(Planner)}


@contextlib.contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """While a stream of blocks is started: the state store that lists and timers need."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)


class Assembler(StatefulProcessor):
    """Records wait until one has come that begins ``delay_s`` later, so batches may bring them in any order within that time; after ``idle_s`` without any, all go on and the open block is closed."""

    def __init__(self, native: float, cfg: Config, delay_s: float, idle_s: float, seconds: dict):
        self.cfg, self.native, self.delay_s, self.idle_s, self.seconds = cfg, native, delay_s, idle_s, seconds
        self.factor, self.out_fs = cfg.decimation(native)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", _CLOCK)
        self.waiting = handle.getListState("waiting", _WAITING)
        self.open = handle.getListState("open", _OPEN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        planner, newest, timer = self._load()
        for pdf in rows:
            new = [(float(r.start_epoch), r.path, int(r.offset), r.component, [float(v) for v in r.samples]) for r in pdf.itertuples() if r.samples is not None and len(r.samples)]
            if new:
                self.waiting.appendList(new)
                newest = max(newest, max(r[0] for r in new))
        if timer:
            self.handle.deleteTimer(timer)
        timer = timerValues.getCurrentProcessingTimeInMs() + int(self.idle_s * 1000)
        self.handle.registerTimer(timer)
        yield from self._go_on(key, planner, newest, timer, newest - self.delay_s)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        planner, newest, timer = self._load()
        if expiredTimerInfo.getExpiryTimeInMs() == timer:
            yield from self._go_on(key, planner, newest, 0, np.inf)

    def _load(self) -> tuple[Planner, float, int]:
        planner = Planner(self.native, self.factor, **self.seconds)
        if not self.clock.exists():
            return planner, -np.inf, 0
        *numbers, newest, timer = self.clock.get()
        for name, value in zip(_NUMBERS, numbers, strict=True):
            setattr(planner, name, value)
        return planner, newest, timer

    def _go_on(self, key, planner: Planner, newest: float, timer: int, until: float) -> Iterator[pd.DataFrame]:
        """Take the waiting records that begin by ``until`` in their order; with all of them, the open block too."""
        held = sorted(tuple(r) for r in self.waiting.get())
        due = [r for r in held if r[0] <= until]
        if len(due) < len(held):
            if due:
                self.waiting.put(held[len(due) :])
        else:
            self.waiting.clear()
        placed, closed = [], []
        for start, _, _, component, samples in due:
            at, blocks = planner.add(start, len(samples))
            if at is not None:
                placed.append((*at, component, list(samples)))
            closed += blocks
        if until == np.inf:
            closed += planner.drain()
        if closed:
            parts = [tuple(r) for r in self.open.get()] + placed
            rows = [self._block(key, b, parts) for b in closed]
            keep = planner.offset - planner.lead
            left = [p for p in parts if p[0] == planner.segment and p[1] + len(p[3]) > keep]
            if left:
                self.open.put(left)
            else:
                self.open.clear()
            yield pd.DataFrame(rows, columns=["station", "segment", "block", "start_epoch", "fs", "e", "n", "z"])
        elif placed:
            self.open.appendList(placed)
        self.clock.update((*(getattr(planner, n) for n in _NUMBERS), newest, timer))

    def _block(self, key, b: Block, parts: list[tuple]) -> tuple:
        first, size = b.offset - b.lead, b.lead + b.take
        grid = {c: np.full(size, np.nan) for c in COMPONENTS}
        for segment, place, component, x in parts:
            lo = place - first
            a, z = max(0, -lo), min(len(x), size - lo)
            if segment == b.segment and z > a:
                grid[component][lo + a : lo + z] = x[a:z]
        out = (process(grid[c], self.native, self.cfg.freqmin, self.cfg.freqmax, self.factor, b.lead + b.phase) for c in COMPONENTS)
        return (key[0], b.segment, b.number, b.start, self.out_fs, *out)


def assemble_stream(records: DataFrame, native: float, cfg: Config, delay_s: float = 60.0, idle_s: float = 300.0, **seconds) -> DataFrame:
    """Blocks (CHUNK) of a stream of station, start_epoch, path, offset, component, samples; start its query within ``state_store``.

    Blocks equal those of a batch run over the same records if none arrives more than ``delay_s`` (by starts of records) behind its turn; those that do may come too late for
    their block and are left out, as in a batch. Lateness follows the ends of records, record by record, which event time watermarks of the engine do not express. A drained station
    goes on where it stopped when more records come.
    """
    grouped = records.select("station", "start_epoch", "path", "offset", "component", "samples").groupBy("station")
    return grouped.transformWithStateInPandas(Assembler(native, cfg, delay_s, idle_s, seconds), CHUNK, "append", "ProcessingTime")
