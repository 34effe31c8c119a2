"""Incremental job: bursts in a text feed, found by the trigger that finds arrivals in a seismogram.

    python -m jobs.feed_triggers --input DIR/documents.parquet --output DIR [--config jobs/feed_triggers.json] [--checkpoint DIR]

Each source of the feed is a station. Its signal is the number of characters that it sent in each cell of ``cell_docs`` consecutive ids, 0 where it sent nothing. The
ratio of the mean square over the last ``short_cells`` cells to that over the last ``long_cells`` (STA/LTA) tells a burst from the source's usual traffic.

The input is a file stream. A run takes the files that the checkpoint does not have yet, in batches of ``files_per_batch``, and ends. A batch adds its counts to
``OUTPUT/cells`` (partitions block and batch) and computes anew only the blocks of ``block_cells`` cells that it touches, and those after them, into ``OUTPUT/triggers``
(partition block). Both are dynamic partition overwrites that depend on the batch and on what is stored only, so a batch that is run again
leaves the same, and files may arrive in any order. Texts are never read twice.
"""

from __future__ import annotations

import argparse
import json
import logging

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tremor import ship
from tremor.functions.kernels import sta_lta

log = logging.getLogger("tremor.jobs.feed_triggers")

DEFAULTS = {"cell_docs": 20, "short_cells": 2, "long_cells": 20, "block_cells": 64, "threshold": 2.0, "files_per_batch": 8}
CELLS = "source string, cell bigint, n_docs bigint, chars bigint, block bigint, batch bigint"
TRIGGERS = "source string, cell bigint, n_docs bigint, chars bigint, ratio double, triggered boolean, block bigint"
#: Source of documents that name none.
UNNAMED = "(none)"


def checked(config: dict) -> dict:
    """``config`` over the defaults; raises for an unknown key or lengths that do not fit each other."""
    if unknown := set(config) - set(DEFAULTS):
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    c = DEFAULTS | config
    if not (0 < c["short_cells"] <= c["long_cells"] <= c["block_cells"] and c["cell_docs"] > 0 and c["files_per_batch"] > 0):
        raise ValueError("need 0 < short_cells <= long_cells <= block_cells, cell_docs and files_per_batch")
    return c


def cells_of(docs: DataFrame, c: dict) -> DataFrame:
    """source, cell, n_docs, chars, block of the documents that have an id; counted before they are shuffled, so a source may hold any share of them."""
    cell = F.expr(f"(doc_id - pmod(doc_id, {c['cell_docs']})) div {c['cell_docs']}")
    rows = docs.where("doc_id is not null").select(F.coalesce("source", F.lit(UNNAMED)).alias("source"), cell.alias("cell"), F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("chars"))
    return rows.groupBy("source", "cell").agg(F.count("*").alias("n_docs"), F.sum("chars").alias("chars")).withColumn("block", _block(c))


def _block(c: dict):
    return F.expr(f"(cell - pmod(cell, {c['block_cells']})) div {c['block_cells']}")


def triggers_of(cells: DataFrame, wanted: DataFrame, c: dict) -> DataFrame:
    """TRIGGERS of the ``wanted`` blocks from ``cells`` (source, cell, n_docs, chars) of those and the blocks before them; a row for each cell with documents."""
    context = c["long_cells"] - 1
    own = cells.withColumn("own", _block(c))
    reach = F.when(F.col("cell") - F.col("own") * c["block_cells"] >= c["block_cells"] - context, F.array("own", F.col("own") + 1)).otherwise(F.array("own"))
    dealt = own.select("source", "cell", "n_docs", "chars", F.explode(reach).alias("block")).join(wanted, "block", "left_semi")

    def ratios(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf.block.iloc[0])
        first = block * c["block_cells"] - context
        x = np.zeros((1, context + c["block_cells"]))
        x[0, pdf.cell - first] = pdf.chars
        ratio = np.round(sta_lta(x, c["short_cells"], c["long_cells"])[0], 6)
        out = pdf[pdf.cell >= first + context].sort_values("cell")
        found = ratio[out.cell - first - context]
        found = np.where(out.cell >= context, found, np.nan)  # before the first whole long average there is no ratio
        return out.assign(ratio=found, triggered=found >= c["threshold"])[["source", "cell", "n_docs", "chars", "ratio", "triggered", "block"]]

    made = dealt.groupBy("source", "block").applyInPandas(ratios, TRIGGERS)
    return made.withColumn("ratio", F.nanvl("ratio", F.lit(None).cast("double")))


def _replace(rows: DataFrame, path: str, *by: str) -> int:
    """Overwrite the partitions that ``rows`` has; how many rows were written."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    return seen.get["rows"]


def run(spark: SparkSession, source: str, output: str, config: dict | None = None, checkpoint: str | None = None) -> DataFrame:
    """Take what is new in the table at ``source``; the whole of ``OUTPUT/triggers`` as it then stands."""
    c = checked(config or {})
    source = source.rstrip("/")
    kinds = spark.read.parquet(source).schema
    path = f"{source[:-1]}[{source[-1]}]"  # a file stream takes a table of one file by a pattern only
    stream = spark.readStream.schema(StructType([kinds[n] for n in ("doc_id", "source", "text")])).option("maxFilesPerTrigger", c["files_per_batch"]).parquet(path)

    def absorb(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        cells = _replace(cells_of(batch, c).withColumn("batch", F.lit(number).cast("bigint")), f"{output}/cells", "block", "batch")
        if not cells:
            log.info("batch %s: read no document with an id", number)
            return
        stored = own.read.schema(CELLS).parquet(f"{output}/cells")
        touched = stored.where(F.col("batch") == number).select(F.explode(F.array("block", F.col("block") + 1)).alias("block")).distinct()
        needed = touched.select(F.explode(F.array("block", F.col("block") - 1)).alias("block")).distinct()
        summed = stored.join(needed, "block", "left_semi").groupBy("source", "cell").agg(F.sum("n_docs").alias("n_docs"), F.sum("chars").alias("chars"))
        written = _replace(triggers_of(summed, touched, c), f"{output}/triggers", "block")
        read = stored.where(F.col("batch") == number).agg(F.sum("n_docs")).first()[0]
        log.info("batch %s: read %s documents with an id, wrote %s cells and %s trigger rows", number, read, cells, written)

    query = stream.writeStream.foreachBatch(absorb).option("checkpointLocation", checkpoint or f"{output}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("%s: %s batches", source, len([p for p in query.recentProgress if p["numInputRows"]]))
    try:
        return spark.read.schema(TRIGGERS).parquet(f"{output}/triggers")
    except Exception as e:  # an input without any document has written nothing
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], TRIGGERS)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser("feed_triggers")
    p.add_argument("--input", required=True, help="the table of documents, a Parquet file or folder")
    p.add_argument("--output", required=True)
    p.add_argument("--config", help="JSON file")
    p.add_argument("--checkpoint", help="OUTPUT/checkpoint unless given")
    args = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = ship(SparkSession.builder.appName("feed_triggers").getOrCreate())
    try:
        config = json.loads(spark.read.text(args.config, wholetext=True).first()[0]) if args.config else {}
        found = run(spark, args.input, args.output, config, args.checkpoint)
        log.info("triggered: %s cells", found.where("triggered").count())
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
