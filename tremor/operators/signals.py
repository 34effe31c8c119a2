"""Signals derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.functions import dialect
from tremor.functions.features import FS, grid
from tremor.operators.scan import numbered

CHUNK = 1024
#: Order of the samples of a station's component.
_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]


def wave_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The centred wave: station, component, i, x. Samples are numbered by their quarter first, so no task sorts a station, and what is scanned is little."""
    flag = F.col("l_returnflag")
    component = F.when(flag == "A", "E").when(flag == "N", "N").when(flag == "R", "Z").alias("component")
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_suppkey", "l_returnflag", component, (F.col("l_quantity") - 25.5).alias("x"), *_ORDER)
    rows = rows.withColumn("quarter", F.trunc("l_shipdate", "quarter"))
    found = numbered(rows, ["l_suppkey", "l_returnflag"], "quarter", _ORDER, "i")
    return found.select(F.col("l_suppkey").alias("station"), "component", "i", "x")


def wave_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The centred wave as pieces of CHUNK samples of three components: station, run, pos, start_epoch, fs, e, n, z."""
    return pieces_of(wave_rows(spark, sf_dir), 1000.0, FS)


def grid_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gapped hourly grid as pieces of one station."""
    rows = dialect.run(spark, sf_dir, lambda d: f"with {grid(d)} select cast(1 as bigint) as station, component, i, x from cells")
    return pieces_of(rows, 0.0, 1.0)


def pieces_of(rows: DataFrame, start: float, fs: float) -> DataFrame:
    """station, component, i, x to arrays by stretches of CHUNK places; places without a row are null. A place has one row a component."""
    base = F.floor(F.col("i") / CHUNK) * CHUNK
    own = lambda c: F.sort_array(F.collect_list(F.when(F.col("component") == c, F.struct("i", "x"))))
    packed = rows.groupBy("station", base.cast("bigint").alias("pos")).agg(*[own(c).alias(c.lower()) for c in "ENZ"])
    last = lambda c: F.coalesce(F.try_element_at(F.col(c), F.lit(-1))["i"], F.col("pos") - 1)
    most = F.greatest(*[last(c) for c in "enz"])
    packed = packed.withColumn("most", most)

    def dense(c: str):
        nulls = lambda n: F.array_repeat(F.lit(None).cast("double"), n.cast("int"))
        gap = lambda r, k: r["i"] - F.coalesce(F.get(F.col(c), k - 1)["i"], F.col("pos") - 1) - 1
        filled = F.flatten(F.transform(c, lambda r, k: F.concat(nulls(gap(r, k)), F.array(r["x"]))))
        whole = last(c) - F.col("pos") + 1 == F.size(c)  # no place is missing up to the last one
        filled = F.when(whole, F.col(c)["x"]).otherwise(filled)
        return F.when(F.col("most") >= F.col("pos"), F.concat(filled, nulls(F.col("most") - last(c)))).alias(c)

    return packed.select("station", F.lit(1).cast("bigint").alias("run"), "pos", (F.lit(start) + F.col("pos") / fs).alias("start_epoch"), F.lit(fs).alias("fs"), *map(dense, "enz"))
