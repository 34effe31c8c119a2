"""The jobs as queries for ``__spark_entry__.py``: each runs twice into one new folder and returns what it has written, read back; and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobs import feature_archive, feed_triggers
from tremor.plans.queries import SQL as SEISMIC
from tremor.shared import new_folder


def job1_feature_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = new_folder(spark, "jobs/feature_archive")
    feature_archive.run(spark, sf_dir, at)
    return feature_archive.run(spark, sf_dir, at)


def job2_feed_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = new_folder(spark, "jobs/feed_triggers")
    feed_triggers.run(spark, f"{sf_dir}/documents.parquet", at)
    return feed_triggers.run(spark, f"{sf_dir}/documents.parquet", at)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (job1_feature_archive, job2_feed_triggers)}

_A, _T = feature_archive.DEFAULTS, feed_triggers.DEFAULTS

SQL: dict[str, str] = {
    "job1_feature_archive": f"""select *, round(({_A["start_epoch"]}e0 + (w * {_A["step"]} + {_A["win"]}) / {_A["fs"]}e0) / 60e0, 6) as end_minute,
  cast(station % {_A["groups"]} as int) as station_group from ({SEISMIC["feature_table"]})""",
    "job2_feed_triggers": f"""
with cells as (select coalesce(source, '{feed_triggers.UNNAMED}') as source, cast(floor(doc_id / {_T["cell_docs"]}e0) as bigint) as cell, cast(count(*) as bigint) as n_docs,
  cast(sum(coalesce(length(text), 0)) as bigint) as chars from documents where doc_id is not null group by 1, 2),
squares as (select *, cast(sum(chars * chars) over (partition by source order by cell range between {_T["short_cells"] - 1} preceding and current row) as double) / {_T["short_cells"]} as near,
  cast(sum(chars * chars) over (partition by source order by cell range between {_T["long_cells"] - 1} preceding and current row) as double) / {_T["long_cells"]} as far from cells),
ratios as (select *, case when cell >= {_T["long_cells"] - 1} then round(case when far = 0 then 0e0 else near / far end, 6) end as ratio from squares)
select source, cell, n_docs, chars, ratio, coalesce(ratio >= {_T["threshold"]}e0, false) as triggered, cast(floor(cell / {_T["block_cells"]}e0) as bigint) as block from ratios""",
}
