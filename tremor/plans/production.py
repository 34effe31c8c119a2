"""Driver queries that run the production operators on signals derived from the test tables; their SQL states the rules on its own, step by step where they are sequential."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.config import Config
from tremor.functions import dialect
from tremor.functions.features import grid
from tremor.operators.condition import detrend, fill_gaps, process
from tremor.operators.scan import running
from tremor.plans.planning import plan_blocks, runs_of, segments_of
from tremor.shared import new_folder, written

#: Seconds of blocks, slack, context and pauses of the records below, whose rate is one sample a minute.
BLOCK_S, SLACK_S, CONTEXT_S, RESET_S, RATE = 14400.0, 1440.0, 3600.0, 28800.0, 1 / 60
STATIONS = 32

_EPOCH = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) / 1e6"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of records of 1 to 100 samples of STATIONS stations, with pauses, disorder and overlaps."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_type in ('click', 'view', 'purchase')")
    component = F.when(F.col("event_type") == "click", "E").when(F.col("event_type") == "view", "N").otherwise("Z")
    late = F.when(F.col("event_id") % 9 == 0, 5000).otherwise(0)  # some records begin long before they are due
    return rows.select(
        (F.col("user_id") % STATIONS).cast("string").alias("station"), F.lit("f").alias("path"), F.col("event_id").alias("offset"), (F.floor(F.expr(_EPOCH)) - 1704067200 - late).cast("double").alias("start_epoch"),
        component.alias("component"), (1 + F.col("event_id") % 100).cast("int").alias("count"), F.lit(RATE).alias("fs"),
    )


def block_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each record's first sample goes: segment, place in the stream, block and its start; nothing for a late one."""
    plan = plan_blocks(written(_records(spark, sf_dir), "records"), 1, BLOCK_S, SLACK_S, CONTEXT_S, RESET_S).where("path is not null")
    own = plan.where("block is null or (first <= place and place < first + take)")
    return own.select(F.col("station").cast("bigint").alias("station"), F.col("offset").alias("record"), F.col("block").isNull().alias("late"), F.col("segment").cast("bigint").alias("segment"), "place", F.col("block").cast("bigint").alias("block"), F.round("start", 3).alias("block_start"))


_BLEN = int(BLOCK_S * RATE)
BLOCK_PLAN_SQL = f"""
with recursive recs as (
  select user_id % {STATIONS} as station, event_id as record, cast(floor(epoch(ts)) - 1704067200 - case when event_id % 9 = 0 then 5000 else 0 end as double) as t, 1 + event_id % 100 as n
  from events where event_type in ('click', 'view', 'purchase')),
o as (select *, row_number() over (partition by station order by t, record) as rn from recs),
walk as (
  select station, record, rn, false as late, cast(0 as bigint) as segment, cast(0 as bigint) as place, cast(0 as bigint) as block, t as block_start,
    t as start, cast(0 as bigint) as off, cast(0 as bigint) as seg, cast(0 as bigint) as num, cast(n as bigint) as filled, t + (n - 1) * 60e0 as wm from o where rn = 1
  union all
  select station, record, rn, shift < 0, case when shift >= 0 then seg end, case when shift >= 0 then off + shift end, case when shift >= 0 then num + shift // {_BLEN} end, case when shift >= 0 then start + (shift // {_BLEN}) * {BLOCK_S}e0 end,
    start + k * {BLOCK_S}e0, off + k * {_BLEN}, seg, num + k, filled2 - k * {_BLEN}, wm2
  from (
    select *, cast(greatest(0, floor((wm2 - start - {SLACK_S}) / {BLOCK_S})) as bigint) as k from (
      select *, case when shift < 0 then filled else greatest(filled, shift + n) end as filled2, case when shift < 0 then wm else greatest(wm, t + (n - 1) * 60e0) end as wm2 from (
        select *, cast(round((t - start) / 60e0) as bigint) as shift from (
          select o.station, o.record, o.rn, o.t, o.n, case when g then o.t else w.start end as start, case when g then w.off + w.filled else w.off end as off, case when g then w.seg + 1 else w.seg end as seg,
            case when g then w.num + cast(ceil(w.filled / {_BLEN}e0) as bigint) else w.num end as num, case when g then 0 else w.filled end as filled, case when g then -1e300 else w.wm end as wm
          from (select w.*, o.t - w.start > {RESET_S} as g from walk w join o on o.station = w.station and o.rn = w.rn + 1) w join o on o.station = w.station and o.rn = w.rn + 1)))))
select station, record, late, segment, place, block, round(block_start, 3) as block_start from walk
"""


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 16 stations at 4 Hz whose starts drift, jump back and pause."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select((F.col("user_id") % 16).cast("string").alias("station"), F.col("event_id").cast("int").alias("block"))
    rows = rows.withColumn("len", (40 + F.col("block") % 30).cast("bigint"))
    step = F.col("len") / 4.0 + F.expr("case block % 13 when 0 then 0.0625D when 3 then -0.03125D when 5 then 0.125D when 7 then 0.375D when 8 then case when block % 5 = 0 then 100D else 0D end else 0D end")
    told = running(rows.withColumn("lot", F.floor(F.col("block") / 4096)), ["station"], "lot", ["block"], at=("sum", step))
    return told.select("station", F.lit(0).alias("segment"), "block", (1000.0 + F.coalesce("at", F.lit(0.0))).alias("start_epoch"), F.lit(4.0).alias("fs"), "len")


def run_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of chunks on one clock, by the samples before each, with their windows of 256 samples in steps of 64 and the number of windows before."""
    _, runs = runs_of(written(_chunks(spark, sf_dir), "chunks"), 256, 64)
    return runs.select(F.col("station").cast("bigint").alias("station"), "run", "windows", "windows_before")


def segment_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of the time axis: first sample and start."""
    return segments_of(written(_chunks(spark, sf_dir), "chunks")).select(F.col("station").cast("bigint").alias("station"), "sample_offset", "start_epoch")


def _clock_sql(breaks: str) -> str:
    """walk: every chunk with sample_offset, begins and the anchor of its clock; ``breaks`` is the condition on off, in samples."""
    return f"""recursive raw as (select user_id % 16 as station, event_id as block, 40 + event_id % 30 as len from events),
steps as (select *, len / 4e0 + case block % 13 when 0 then 0.0625 when 3 then -0.03125 when 5 then 0.125 when 7 then 0.375 when 8 then case when block % 5 = 0 then 100 else 0 end else 0 end as step from raw),
c as (select station, block, len, 1000e0 + coalesce(sum(step) over (partition by station order by block rows between unbounded preceding and 1 preceding), 0) as start_epoch,
  cast(coalesce(sum(len) over (partition by station order by block rows between unbounded preceding and 1 preceding), 0) as bigint) as sample_offset, row_number() over (partition by station order by block) as rn from steps),
walk as (
  select station, rn, len, sample_offset, start_epoch, true as begins, sample_offset as anchor_offset, start_epoch as anchor_start from c where rn = 1
  union all
  select station, rn, len, sample_offset, start_epoch, b, case when b then sample_offset else ao end, case when b then start_epoch else a end from (
    select c.*, w.anchor_offset as ao, w.anchor_start as a, {breaks.format(off="abs(c.start_epoch - (w.anchor_start + (c.sample_offset - w.anchor_offset) / 4e0)) * 4")} as b
    from walk w join c on c.station = w.station and c.rn = w.rn + 1))"""


RUN_WINDOWS_SQL = f"""with {_clock_sql("{off} > 1.5")},
runs as (select station, anchor_offset as run, cast(sum(len) as bigint) as samples from walk group by 1, 2),
sized as (select *, cast(greatest(0, floor((samples - 256) / 64e0) + 1) as bigint) as windows from runs)
select station, run, windows, cast(coalesce(sum(windows) over (partition by station order by run rows between unbounded preceding and 1 preceding), 0) as bigint) as windows_before from sized"""

SEGMENT_STARTS_SQL = f"""with {_clock_sql("not ({off} < 0.5)")} select station, sample_offset, start_epoch from walk where begins"""

#: Cells of a block of the hourly grid and of its context, the band in cycles a cell, and the factor of decimation.
CELLS, CONTEXT, LOW, HIGH, FACTOR = 48, 12, 1 / 24, 1 / 5, 2


def conditioned_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of the gapped hourly grid with the context before them, each conditioned on its own: gaps filled (``filled`` where there was no sample), trend taken off, filtered, and every second cell of the grid."""
    cells = dialect.run(spark, sf_dir, lambda d: f"with {grid(d)} select component, i, x from full_grid")
    own = F.floor(F.col("i") / CELLS)
    dealt = cells.withColumn("block", F.explode(F.when(F.pmod("i", F.lit(CELLS)) >= CELLS - CONTEXT, F.array(own, own + 1)).otherwise(F.array(own)))).where(F.col("i") >= F.col("block") * CELLS - CONTEXT)

    def condition(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        i, x = pdf.i.to_numpy(), pdf.x.to_numpy(float)
        block = int(pdf.block.iloc[0])
        filled = fill_gaps(x)
        flat = detrend(filled)
        skip = int((i < block * CELLS).sum())
        if skip == len(i):  # context of a block that the grid does not reach
            return pdf[["component", "block", "i"]].iloc[:0].assign(filled=0.0, flat=0.0, x=0.0)
        skip += -int(i[skip]) % FACTOR
        out = process(x, 1.0, LOW, HIGH, FACTOR, skip)
        kept = slice(skip, None, FACTOR)
        return pd.DataFrame({"component": pdf.component.iloc[0], "block": block, "i": i[kept], "filled": np.where(np.isnan(x), filled, np.nan)[kept], "flat": flat[kept], "x": out})

    made = dealt.groupBy("component", "block").applyInPandas(condition, "component string, block bigint, i bigint, filled double, flat double, x double")
    null = F.lit(None).cast("double")
    return made.select("component", "block", "i", *[(F.round(F.nanvl(c, null), n) + 0.0).alias(c) for c, n in (("filled", 4), ("flat", 5), ("x", 4))])


def _filtered_sql(dealt: str, low: float, high: float, kept: str) -> str:
    """CTEs flat (component, block, i, p, f, gap, x) and back (component, block, p, x): blocks with gaps filled (f), without trend (x), and filtered between ``low`` and ``high`` cycles a cell where ``kept``.

    ``dealt``: component, block, i, x of each block with its context. The filter is the definition of the transform over the odd-extended block, with squared gains.
    """
    d, reach = dialect.DUCK, int(3 / low)
    part = "over (partition by component, block order by p)"
    before = "over (partition by component, block order by p rows between unbounded preceding and current row)"
    after = "over (partition by component, block order by p rows between current row and unbounded following)"
    w1, w2 = (f"(2e0 * tan(pi() * {f!r}))" for f in (low, high))
    return f"""with {grid(d)},
dealt as ({dealt}),
buf as (select component, block, i, x, row_number() over (partition by component, block order by i) - 1 as p, count(*) over (partition by component, block) as m, max(i) over (partition by component, block) as top from dealt),
near as (select *, lag(x) {part} as px, lead(x) {part} as nx from buf where top >= block * {CELLS}),
ends as (select *, last_value(case when x is not null then p end ignore nulls) {before} as l, last_value(x ignore nulls) {before} as y0, first_value(case when x is not null then p end ignore nulls) {after} as r,
  first_value(x ignore nulls) {after} as y1, last_value(case when x is not null then coalesce(px, 1e308) end ignore nulls) {before} as pl, first_value(case when x is not null then coalesce(nx, 1e308) end ignore nulls) {after} as nr from near),
slopes as (select *, cast(r - l as double) as d, cast(p - l as double) / nullif(r - l, 0) as t, case when l = 0 then y1 - y0 when pl = 1e308 then null else (y1 - pl) * (r - l) / (r - l + 1e0) end as m0,
  case when r = m - 1 then y1 - y0 when nr = 1e308 then null else (nr - y0) * (r - l) / (r - l + 1e0) end as m1 from ends),
filled as (select component, block, i, p, m, x is null as gap, case when x is not null then x else y0 + t * m0 + t * t * (3 * (y1 - y0) - 2 * m0 - m1) + t * t * t * (m0 + m1 - 2 * (y1 - y0)) end as f from slopes),
fit as (select component, block, any_value(m) as m, count(f) as n, avg(f) as mf, avg(case when f is not null then p end) as mp, covar_pop(f, case when f is not null then cast(p as double) end) as cov, var_pop(case when f is not null then cast(p as double) end) as var from filled group by 1, 2),
flat as (select component, block, i, p, m, n, f, gap, case when m < 2 then f else f - mf - case when var > 0 then cov / var else 0 end * (p - mp) end as x from filled join fit using (component, block, m)),
shape as (select component, block, m, least(m - 1, {reach + 1}) as pad, cast(pow(2, floor(log2(m + 2 * least(m - 1, {reach + 1}) + {2 * reach})) + 1) as bigint) as size from fit where n > 0),
y as (select component, block, p, coalesce(x, 0) as y from flat),
edge as (select component, block, arg_min(y, p) as first, arg_max(y, p) as last from y group by 1, 2),
long as (
  select y.component, y.block, p + pad as t, y from y join shape using (component, block)
  union all select y.component, y.block, pad - p, 2 * first - y from y join shape using (component, block) join edge using (component, block) where p between 1 and pad
  union all select y.component, y.block, pad + 2 * (m - 1) - p, 2 * last - y from y join shape using (component, block) join edge using (component, block) where m - 1 - p between 1 and pad),
freq as (select component, block, size, unnest(range(1, size // 2)) as k from shape),
turned as (select component, block, k, size, sum(y * cos(2 * pi() * ((k * t) % size) / size)) as re, sum(y * sin(2 * pi() * ((k * t) % size) / size)) as im from freq join long using (component, block) group by 1, 2, 3, 4),
gained as (select *, 1 / (1 + pow((w * w - {w1} * {w2}) / (w * ({w2} - {w1})), 8)) as g from (select *, 2 * tan(pi() * k / size) as w from turned)),
back as (select component, block, p, sum(2 * g / size * (re * cos(2 * pi() * ((k * (p + pad)) % size) / size) + im * sin(2 * pi() * ((k * (p + pad)) % size) / size))) as x
  from gained join shape using (component, block, size) join (select component, block, p, i from flat where {kept}) using (component, block) group by 1, 2, 3)"""


_KEPT = f"i % {FACTOR} = 0 and i >= block * {CELLS}"
_CONDITIONED_SQL = (
    _filtered_sql(f"select component, i, x, unnest(case when i % {CELLS} >= {CELLS - CONTEXT} then [i // {CELLS}, i // {CELLS} + 1] else [i // {CELLS}] end) as block from full_grid", LOW, HIGH, _KEPT)
    + f""" select component, block, i, case when gap then round(f, 4) + 0e0 end as filled, round(flat.x, 5) + 0e0 as flat, case when f is not null then round(back.x, 4) + 0e0 end as x
from flat left join back using (component, block, p) where {_KEPT}"""
)

#: The whole grid as one block, between a cycle in two days and one in five hours; for the query of that name.
BANDPASS_SQL = _filtered_sql("select component, i, x, 0 as block from full_grid", 1 / 48, 1 / 5, "true") + " select component, i, case when f is not null then round(back.x, 6) + 0e0 end as x from flat left join back using (component, block, p)"


def waveform_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly grid of three components as a flat waveform, written by the tasks that hold it and read back from its parts: place and samples in single precision."""
    from tremor.sinks import write_waveform

    cells = dialect.run(spark, sf_dir, lambda d: f"with {grid(d)} select component, i, x from full_grid")
    wide = cells.groupBy("i").pivot("component", ["E", "N", "Z"]).agg(F.max("x")).withColumn("block", F.floor(F.col("i") / CELLS).cast("int"))
    listed = wide.groupBy("block").agg(F.min("i").alias("lo"), F.sort_array(F.collect_list(F.struct("i", *[F.coalesce(c, F.lit(float("nan"))).alias(c.lower()) for c in "ENZ"]))).alias("rows"))
    blocks = listed.select(F.lit("s").alias("station"), F.lit(0).alias("segment"), "block", F.col("lo").cast("double").alias("start_epoch"), F.lit(1.0).alias("fs"), *[F.col(f"rows.{c}").alias(c) for c in "enz"])
    blocks = written(blocks, "blocks")
    at = new_folder(spark, "tremor/waveform")
    write_waveform(blocks, blocks.select("station", "segment", "block", "start_epoch", "fs", F.size("e").cast("bigint").alias("len")), at, Config())

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                x = np.frombuffer(content.as_buffer(), "<f4").reshape(-1, 3).astype(float)
                first = int(path.rpartition("part-")[2].removesuffix(".f32"))
                yield pa.RecordBatch.from_arrays([pa.array(first + np.arange(len(x))), *(pa.array(x[:, c], from_pandas=True) for c in range(3))], names=["sample", "e", "n", "z"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(at).select("path", "content").mapInArrow(parts, "sample bigint, e double, n double, z double")


def _waveform_sql() -> str:
    value = lambda c: f"cast(cast(max(case when component = '{c}' then x end) as float) as double) as {c.lower()}"
    return f"with {grid(dialect.DUCK)} select i - (select min(i) from full_grid) as sample, {', '.join(map(value, 'ENZ'))} from full_grid group by i"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (block_plan, run_windows, segment_starts, conditioned_blocks, waveform_parts)}
SQL: dict[str, str] = {"block_plan": BLOCK_PLAN_SQL, "run_windows": RUN_WINDOWS_SQL, "segment_starts": SEGMENT_STARTS_SQL, "conditioned_blocks": _CONDITIONED_SQL, "waveform_parts": _waveform_sql()}
