"""tremor: three-component seismic time series on Spark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from the folder that the driver runs it from; on a cluster without that folder pass it by --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))) if x)
    return spark
