"""Running sums, maxima, last values and numbers over long ordered keys in two levels.

Rows of a key (a station, say) are ordered by a bucket first (a day, a stretch of places). What stands before a bucket is a scan over one row per key and bucket; within a bucket an
ordinary window does. So no task sorts the rows of a key, which may hold any share of the table; only the rows of a bucket, and one row per bucket of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How a fold is taken over windows of rows in order; over the rows of a bucket "last" needs their order.
_OVER = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}


def _within(fold: str, c: Column, order: list[str]) -> Column:
    return F.max_by(c, F.struct(*order)) if fold == "last" else _OVER[fold](c)


def before(rows: DataFrame, keys: list[str], bucket: str, order: list[str], **folds: tuple[str, Column]) -> DataFrame:
    """``rows`` with ``name``, the fold ("sum", "max" or "last") of a column over all rows of earlier buckets of the same keys, for each ``name=(fold, column)``; null before the first bucket.

    Rows whose keys or bucket are null come back with null. ``rows`` is evaluated twice, so write it first if it is dear. Null is no last value if a bucket ends with it.
    """
    parts = rows.groupBy(*keys, bucket).agg(*[_within(fold, c, order).alias(n) for n, (fold, c) in folds.items()])
    over = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    scanned = parts.select(*keys, bucket, *[_OVER[fold](F.col(n)).over(over).alias(n) for n, (fold, _) in folds.items()])
    return rows.join(scanned, [*keys, bucket], "left")


def numbered(rows: DataFrame, keys: list[str], bucket: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``, 0, 1, 2 .. in the order of (bucket, *order) within the keys."""
    at = F.row_number().over(Window.partitionBy(*keys, bucket).orderBy(*order)) - 1
    found = before(rows, keys, bucket, order, **{name: ("sum", F.lit(1))})
    return found.withColumn(name, (F.coalesce(name, F.lit(0)) + at).cast("bigint"))


def running(rows: DataFrame, keys: list[str], bucket: str, order: list[str], **folds: tuple[str, Column]) -> DataFrame:
    """``rows`` with ``name``, the fold of a column over all rows before each in the order of (bucket, *order); null for the first of a key."""
    own = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = before(rows, keys, bucket, order, **folds)
    for name, (fold, c) in folds.items():
        here = _OVER[fold](c).over(own)
        both = {"sum": F.coalesce(F.col(name) + here, name, here), "max": F.greatest(name, here), "last": F.coalesce(here, name)}[fold]
        found = found.withColumn(name, both)
    return found


def differences(rows: DataFrame, keys: list[str], place: str, columns: list[str], suffix: str, span: int = 4096) -> DataFrame:
    """``rows`` with each of ``columns`` minus its value at the place before, as ``column + suffix``; ``place`` numbers the rows of the keys without a break.

    Rows are dealt out by stretches of ``span`` places, and the last of a stretch also goes to the next one, so each row is sent once and no key is sorted as a whole.
    """
    own = F.floor(F.col(place) / span).cast("bigint")
    last = F.pmod(F.col(place), F.lit(span)) == span - 1
    dealt = rows.withColumn("_stretch", F.explode(F.when(last, F.array(own, own + 1)).otherwise(F.array(own))))
    over = Window.partitionBy(*keys, "_stretch").orderBy(place)
    steps = [(F.col(c) - F.lag(c).over(over)).alias(f"{c}{suffix}") for c in columns]
    return dealt.select("*", *steps).where(F.col("_stretch") == own).drop("_stretch")
