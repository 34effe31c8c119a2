"""One text of a query for two engines: what Spark SQL and DuckDB spell differently."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Spark:
    spark = True

    def table(self, name: str) -> str:
        return "{" + name + "}"

    def epoch(self, ts: str) -> str:
        return f"(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts}) / 1e6)"

    def each(self, lo: str, hi: str) -> str:
        return f"explode(sequence({lo}, {hi}))"

    def div(self, a: str, b: str) -> str:
        return f"try_divide({a}, {b})"

    def arg_max(self, v: str, *by: str) -> str:
        return f"max_by({v}, struct({', '.join(by)}))"

    def last(self, v: str) -> str:
        return f"last_value({v}, true)"

    def first(self, v: str) -> str:
        return f"first_value({v}, true)"

    def pad2(self, v: str) -> str:
        return f"format_string('%02d', {v})"


class Duck(Spark):
    spark = False

    def table(self, name: str) -> str:
        return name

    def epoch(self, ts: str) -> str:
        return f"epoch({ts})"

    def each(self, lo: str, hi: str) -> str:
        return f"unnest(range({lo}, {hi} + 1))"

    def div(self, a: str, b: str) -> str:
        return f"(case when ({b}) = 0 then null else ({a}) / ({b}) end)"

    def arg_max(self, v: str, *by: str) -> str:
        return f"arg_max({v}, row({', '.join(by)}))"

    def last(self, v: str) -> str:
        return f"last_value({v} ignore nulls)"

    def first(self, v: str) -> str:
        return f"first_value({v} ignore nulls)"

    def pad2(self, v: str) -> str:
        return f"printf('%02d', {v})"


SPARK, DUCK = Spark(), Duck()
Text = Callable[[Spark], str]


def tables_in(text: Text) -> list[str]:
    """Test tables that a query names."""
    return sorted(set(re.findall(r"\{(\w+)\}", text(SPARK))))


def run(spark: SparkSession, sf_dir: str, text: Text) -> DataFrame:
    return spark.sql(text(SPARK), **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables_in(text)})
