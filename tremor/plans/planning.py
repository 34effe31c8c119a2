"""From an index of records to blocks, runs and segments, in parallel and from metadata only.

The rules are sequential (``tremor.operators.assemble.Planner``), but what they carry along is little:

* A record that begins more than the reset length after all that came before it always starts the clock anew, since the open block begins no later than that. So the
  index falls into pieces there, whose plans depend on each other by sums only (samples, segments and blocks before), which a scan adds.
* In a piece where no pause is long enough to reset the clock by any position of the open block, and no record outlasts a block, the blocks that are out before a record follow from
  the running end of the records before it. Such pieces are planned by expressions, record by record; the others by a ``Planner``, one task a piece.
* A clock of chunks surely breaks where the offset between start and samples jumps by twice the tolerance, so chunks fall into stretches there, and only a stretch whose
  offsets span the tolerance is walked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.config import BLOCK_S, CONTEXT_S, RESET_S, SLACK_S
from tremor.operators.assemble import Planner
from tremor.operators.scan import running
from tremor.shared import written

ORDER = ["start_epoch", "path", "offset"]
#: Seconds, and chunks, of a bucket of the scans.
DAY, CHUNKS = 86400.0, 1024
PLAN = "station string, piece bigint, path string, offset bigint, place bigint, segment int, block int, start double, first bigint, take int, lead int"
_BLOCK = ["segment", "block", "start", "first", "take", "lead"]


def cut_at_pauses(index: DataFrame, reset_s: float) -> DataFrame:
    """The records of ``index`` that hold samples, with day, end (last sample before the record, null for the first), cut (1 where a piece begins) and piece (1, 2 ..)."""
    rows = index.where("count > 0").withColumn("day", F.floor(F.col("start_epoch") / DAY))
    rows = running(rows, ["station"], "day", ORDER, end=("max", F.col("start_epoch") + (F.col("count") - 1) / F.col("fs")))
    rows = rows.withColumn("cut", (F.col("end").isNull() | (F.col("start_epoch") - F.col("end") > reset_s)).cast("int"))
    rows = running(written(rows, "pauses"), ["station"], "day", ORDER, piece=("sum", F.col("cut")))
    return written(rows.withColumn("piece", F.coalesce("piece", F.lit(0)) + F.col("cut")), "pieces")


def _stepwise(rows: DataFrame, factor: int, seconds: dict) -> DataFrame:
    """PLAN of pieces by a Planner each: a row for each record and block that holds samples of it, one with a null block for a late record, one with a null path for a block without records."""

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ORDER, kind="stable").reset_index(drop=True)
        p = Planner(float(pdf.fs.iloc[0]), factor, **seconds)
        places, blocks = [], []
        for start, count in zip(pdf.start_epoch, pdf["count"], strict=True):
            at, closed = p.add(start, int(count))
            places.append(-1 if at is None else at[1])
            blocks += closed
        blocks += p.drain()
        table = pd.DataFrame([(b.segment, b.number, b.start, b.offset, b.take, b.lead) for b in blocks], columns=_BLOCK)
        place, count = np.array(places, np.int64), pdf["count"].to_numpy(np.int64)
        # Blocks that end after the record's first sample, up to those whose context begins before its end; segments follow each other in places too.
        lo = np.searchsorted((table["first"] + table["take"]).to_numpy(), place, "right")
        hi = np.where(place < 0, lo, np.searchsorted((table["first"] - table["lead"]).to_numpy(), place + count, "left"))
        times = np.maximum(hi - lo, 0)
        record = np.repeat(np.arange(len(pdf)), times)
        block = np.repeat(lo - (np.cumsum(times) - times), times) + np.arange(times.sum())
        out = pd.concat([pdf.loc[record, ["path", "offset"]].reset_index(drop=True), table.loc[block].reset_index(drop=True)], axis=1).assign(place=place[record])
        late = pdf.loc[place < 0, ["path", "offset"]]
        empty = table.drop(index=np.unique(block))
        out = pd.concat([out, late, empty]).assign(station=pdf.station.iloc[0], piece=pdf.piece.iloc[0])
        return out.reindex(columns=[c.split()[0] for c in PLAN.split(", ")]).astype({c: "Int64" for c in ("offset", "place", "segment", "block", "first", "take", "lead")})

    return rows.groupBy("station", "piece").applyInPandas(plan, PLAN)


def _by_expressions(rows: DataFrame, block_s: float, slack_s: float, context_s: float) -> DataFrame:
    """The same for pieces without a reset or a record that outlasts a block. ``rows`` has first_start, the start of the piece."""
    fs = F.col("fs")
    size = F.round(F.lit(block_s) * fs).cast("bigint")
    end = F.when(F.col("cut") == 0, F.col("end"))
    out = F.greatest(F.lit(0.0), F.floor((F.coalesce(end, "first_start") - F.col("first_start") - slack_s) / block_s)).cast("bigint")  # blocks that are out before the record
    shift = F.round((F.col("start_epoch") - (F.col("first_start") + out * size / fs)) * fs).cast("bigint")
    placed = rows.select("station", "piece", "path", "offset", "count", "fs", "first_start", size.alias("size"), F.when(shift >= 0, out * size + shift).alias("place"))
    totals = placed.groupBy("station", "piece").agg(F.max(F.col("place") + F.col("count")).alias("total"), F.first("first_start").alias("first_start"), F.first("size").alias("size"), F.first("fs").alias("fs"))
    lead = F.least(F.floor(F.lit(context_s) * fs).cast("bigint"), "size")
    first = F.col("block") * F.col("size")
    facts = [F.lit(0).alias("segment"), F.col("block").cast("int").alias("block"), (F.col("first_start") + first / fs).alias("start"), first.alias("first"), F.least("size", F.col("total") - first).cast("int").alias("take"), F.when(F.col("block") > 0, lead).otherwise(0).cast("int").alias("lead")]
    known = placed.where("place is not null").join(totals.select("station", "piece", "total"), ["station", "piece"])
    # A record is in the blocks from that of its first sample to that whose context holds its last one.
    ends = F.least(F.floor((F.col("place") + F.col("count") - 1 + lead) / F.col("size")), F.floor((F.col("total") - 1) / F.col("size")))
    dealt = known.withColumn("block", F.explode(F.sequence(F.floor(F.col("place") / F.col("size")), ends.cast("bigint"))))
    held = dealt.select("station", "piece", "path", "offset", "place", *facts)
    late = placed.where("place is null").select("station", "piece", "path", "offset", *[F.lit(None).alias(c) for c in ("place", *_BLOCK)])
    every = totals.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("total") - 1) / F.col("size")))))
    empty = every.join(held.select("station", "piece", "block"), ["station", "piece", "block"], "left_anti")
    empty = empty.select("station", "piece", F.lit(None).alias("path"), F.lit(None).alias("offset"), F.lit(None).alias("place"), *facts)
    return held.union(late).union(empty)


def plan_blocks(index: DataFrame, factor: int, block_s: float = BLOCK_S, slack_s: float = SLACK_S, context_s: float = CONTEXT_S, reset_s: float = RESET_S) -> DataFrame:
    """Where each record goes: a row for each block that holds samples of it, as its own or as context. ``index``: station, path, offset, start_epoch, component, count, fs.

    Of a late record nothing is placed: it has one row with a null block. A block that no record reaches has one row with a null path. Records without samples have none. The result
    is a table in the shared folder: PLAN, start_epoch of the record, and phase, the samples of the block before the first on the decimation grid.
    """
    seconds = {"block_s": block_s, "slack_s": slack_s, "context_s": context_s, "reset_s": reset_s}
    rows = cut_at_pauses(index, reset_s)
    pause = F.when(F.col("cut") == 0, F.col("start_epoch") - F.col("end"))
    facts = rows.groupBy("station", "piece").agg(F.min("start_epoch").alias("first_start"), F.max(pause).alias("pause"), F.max((F.col("count") - 1) / F.col("fs")).alias("longest"))
    regular = (F.coalesce("pause", F.lit(0.0)) <= reset_s - block_s - slack_s) & (F.col("longest") < block_s + slack_s)
    rows = rows.join(facts.select("station", "piece", "first_start", regular.alias("regular")), ["station", "piece"])
    plan = written(_by_expressions(rows.where("regular"), block_s, slack_s, context_s).union(_stepwise(rows.where("not regular"), factor, seconds)), "piece-plans")
    sizes = plan.groupBy("station", "piece").agg(F.max(F.col("first") + F.col("take")).alias("n"), (F.max("segment") + 1).alias("s"), (F.max("block") + 1).alias("b"))
    sizes = sizes.withColumn("lot", F.floor(F.col("piece") / CHUNKS))
    sums = running(sizes, ["station"], "lot", ["piece"], samples=("sum", F.col("n")), segments=("sum", F.col("s")), blocks=("sum", F.col("b")))
    sums = sums.select("station", "piece", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("samples", "segments", "blocks")])
    plan = plan.join(sums, ["station", "piece"])
    first = F.col("first") + F.col("samples")
    shifted = plan.select(
        "station", "piece", "path", "offset", (F.col("place") + F.col("samples")).alias("place"), (F.col("segment") + F.col("segments")).cast("int").alias("segment"), (F.col("block") + F.col("blocks")).cast("int").alias("block"),
        "start", first.alias("first"), "take", "lead", F.pmod(-first, F.lit(factor)).cast("int").alias("phase"),
    )
    return written(shifted.join(index.select("station", "path", "offset", "start_epoch"), ["station", "path", "offset"], "left"), "plan")


def chunks_of(plan: DataFrame, factor: int, native: float) -> DataFrame:
    """station, segment, block, start_epoch, fs, len (samples after decimation) of each block of a plan."""
    length = F.greatest(F.lit(0), F.floor((F.col("take") - F.col("phase") + factor - 1) / factor)).cast("bigint")
    return plan.where("block is not null").select("station", "segment", "block", F.col("start").alias("start_epoch"), F.lit(native / factor).alias("fs"), length.alias("len")).distinct()


CLOCKED = "station string, segment int, block int, start_epoch double, fs double, len bigint, sample_offset bigint, begins boolean, anchor_offset bigint, anchor_start double"


def clocked(chunks: DataFrame, tolerance: float, inclusive: bool) -> DataFrame:
    """CLOCKED: the ``chunks`` (station, segment, block, start_epoch, fs, len) that hold samples, with sample_offset, the station's samples before each, and the chunk that its clock begins with.

    A clock begins with a chunk, at anchor_start and sample anchor_offset, and goes on until a chunk starts more than ``tolerance`` samples (with ``inclusive``: that or more) from
    where the clock puts it: the rule refers to the chunk that the clock began with, not to the one before. ``begins`` marks the chunks that clocks begin with.
    """
    keys, order = ["station"], ["block"]
    rows = chunks.where("len > 0").withColumn("lot", F.floor(F.col("block") / CHUNKS))
    rows = running(rows, keys, "lot", order, sample_offset=("sum", F.col("len"))).withColumn("sample_offset", F.coalesce("sample_offset", F.lit(0)))
    rows = written(rows.withColumn("lag", F.col("start_epoch") - F.col("sample_offset") / F.col("fs")), "clock-lags")
    rows = running(rows, keys, "lot", order, old=("last", F.col("lag")))
    sure = (F.col("old").isNull() | (F.abs(F.col("lag") - F.col("old")) > 2.01 * tolerance / F.col("fs"))).cast("int")
    rows = written(rows.withColumn("sure", sure), "clock-breaks")
    rows = running(rows, keys, "lot", order, stretch=("sum", F.col("sure")))
    rows = written(rows.withColumn("stretch", F.coalesce("stretch", F.lit(0)) + F.col("sure")), "clock-stretches")
    ends = rows.groupBy("station", "stretch").agg((F.max("lag") - F.min("lag")).alias("spread"), F.min_by(F.struct("sample_offset", "start_epoch", "block"), "block").alias("anchor"), F.min("fs").alias("least"))
    rows = rows.join(ends.select("station", "stretch", "anchor", (F.col("spread") < 0.99 * tolerance / F.col("least")).alias("whole")), ["station", "stretch"])
    names = [c.split()[0] for c in CLOCKED.split(", ")]
    whole = rows.where("whole").select(*names[:7], (F.col("block") == F.col("anchor.block")).alias("begins"), F.col("anchor.sample_offset").alias("anchor_offset"), F.col("anchor.start_epoch").alias("anchor_start"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = anchor_at = anchor_start = None  # of the row before, which may stand in another batch
        for b in batches:
            begins, offsets, starts = [], [], []
            for *now, start, at, fs in zip(*(b.column(c).to_pylist() for c in ("station", "stretch", "start_epoch", "sample_offset", "fs")), strict=True):
                if new := now != key:
                    key = now
                else:
                    off = abs(start - (anchor_start + (at - anchor_at) / fs))
                    new = off > tolerance / fs or (inclusive and off == tolerance / fs)
                if new:
                    anchor_at, anchor_start = at, start
                begins.append(new)
                offsets.append(anchor_at)
                starts.append(anchor_start)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names[:7]), pa.array(begins, pa.bool_()), pa.array(offsets, pa.int64()), pa.array(starts, pa.float64())], names=names)

    # Stretches are many and short, so a task walks its own one after the other; a long one is not held, only its anchor. They are dealt out by a hash of their keys: by the
    # keys themselves they would lie so already after the join, Spark leaves out such a shuffle, and may then split that of the join, whose own rows need not lie together.
    deal = F.xxhash64("station", "stretch")
    doubtful = rows.where("not whole").select("stretch", *names[:7]).repartition(deal).sortWithinPartitions("station", "stretch", "block")
    return whole.union(doubtful.mapInArrow(walk, CLOCKED))


def runs_of(chunks: DataFrame, win: int, step: int) -> tuple[DataFrame, DataFrame]:
    """(places, runs). places: station, segment, block, run, pos (first sample within the run) and epoch (start of the run's clock) of chunks with samples. runs: station, run, windows, and windows_before.

    A run is a stretch of chunks on one clock, up to 1.5 samples; windows do not reach from one into the next. It is named by the number of the station's samples before it.
    """
    rows = written(clocked(chunks, 1.5, False), "runs")
    run = F.col("anchor_offset").alias("run")
    places = rows.select("station", "segment", "block", run, (F.col("sample_offset") - F.col("anchor_offset")).alias("pos"), F.col("anchor_start").alias("epoch"))
    sizes = rows.groupBy("station", run).agg(F.sum("len").alias("samples")).withColumn("lot", F.floor(F.col("run") / (1 << 30)))
    sizes = sizes.withColumn("windows", F.greatest(F.lit(0), F.floor((F.col("samples") - win) / step) + 1).cast("bigint"))
    found = running(sizes, ["station"], "lot", ["run"], windows_before=("sum", F.col("windows")))
    return places, found.select("station", "run", "windows", F.coalesce("windows_before", F.lit(0)).alias("windows_before"))


def segments_of(chunks: DataFrame) -> DataFrame:
    """station, sample_offset, start_epoch of each segment of the time axis: it begins with a chunk that starts half a sample or more from where the segment before puts it."""
    return clocked(chunks, 0.5, True).where("begins").select("station", "sample_offset", "start_epoch")
