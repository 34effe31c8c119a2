"""Batch job: the feature archive that models are trained on.

    python -m jobs.feature_archive --input DIR --output DIR [--config jobs/feature_archive.json]

The samples of every station are cut into hopping windows of three components, and each window becomes one row of the 51 features, labelled by the time of its end. The
archive is partitioned by group of stations (``station mod groups``), so that a reader of some stations opens few files. Writes overwrite the partitions that they bring and no others:
a run that is repeated leaves the same, and a run for ``only_groups`` renews those groups and leaves the rest as it was.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tremor import ship
from tremor.functions import features as wave
from tremor.functions.kernels import FEATURES
from tremor.operators.signals import pieces_of, wave_rows
from tremor.plans.pipeline import window_features
from tremor.plans.queries import rounded

log = logging.getLogger("tremor.jobs.feature_archive")

DEFAULTS = {"win": wave.WIN, "step": wave.STEP, "fs": wave.FS, "start_epoch": 1000.0, "short_average": wave.NSTA, "long_average": wave.NLTA, "groups": 8, "only_groups": None}
SCHEMA = "station bigint, w bigint, end_minute double, " + ", ".join(f"`{f}` double" for f in FEATURES) + ", station_group int"


def checked(config: dict) -> dict:
    """``config`` over the defaults; raises for an unknown key or lengths that do not fit each other."""
    if unknown := set(config) - set(DEFAULTS):
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    c = DEFAULTS | config
    if not (0 < c["short_average"] <= c["long_average"] < c["win"] and c["step"] > 0 and c["fs"] > 0 and c["groups"] > 0):
        raise ValueError("need 0 < short_average <= long_average < win, step, fs and groups")
    return c


def run(spark: SparkSession, tables: str, output: str, config: dict | None = None) -> DataFrame:
    """Renew the archive at ``output`` from the samples in ``tables``; the whole archive as it then stands."""
    c = checked(config or {})
    group = F.pmod(F.col("station"), F.lit(c["groups"])).cast("int")
    samples, read, written = wave_rows(spark, tables), Observation(), Observation()
    if c["only_groups"] is not None:
        samples = samples.where(group.isin(c["only_groups"]))
    pieces = pieces_of(samples, c["start_epoch"], c["fs"]).observe(read, F.count(F.lit(1)).alias("pieces"), F.sum(F.size("e") + F.size("n") + F.size("z")).alias("samples"))
    found = window_features(pieces, c["win"], c["step"], c["short_average"], c["long_average"])
    rows = found.select("station", "w", F.round(F.col("end_epoch") / 60, 6).alias("end_minute"), *map(rounded, FEATURES), group.alias("station_group"))
    rows = rows.observe(written, F.count(F.lit(1)).alias("windows"))
    ready = rows.repartition("station_group", F.pmod(F.xxhash64("station"), F.lit(16))).sortWithinPartitions("station_group", "station", "w")
    ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("station_group").parquet(output)
    log.info("%s: read %s samples in %s pieces, wrote %s windows to %s", tables, read.get["samples"], read.get["pieces"], written.get["windows"], output)
    return spark.read.schema(SCHEMA).parquet(output)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser("feature_archive")
    p.add_argument("--input", required=True, help="the folder of tables with lineitem.parquet")
    p.add_argument("--output", required=True)
    p.add_argument("--config", help="JSON file")
    args = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = ship(SparkSession.builder.appName("feature_archive").getOrCreate())
    try:
        run(spark, args.input, args.output, json.loads(spark.read.text(args.config, wholetext=True).first()[0]) if args.config else {})
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
