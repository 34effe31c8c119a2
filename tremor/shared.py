"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Where that is unset a local master, as in tests, gets a local folder; a cluster is refused, since no folder of one machine would do."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = os.path.join(tempfile.gettempdir(), "tremor-checkpoints")
    return at.rstrip("/")


def new_folder(spark: SparkSession, what: str) -> str:
    """A path in the shared folder, unique for each call."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def written(rows: DataFrame, what: str) -> DataFrame:
    """``rows`` as a table in the shared folder: what follows neither computes them again nor depends on executors that may be lost."""
    spark = rows.sparkSession
    path = new_folder(spark, f"tremor/{what}")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
