"""Ordered scans that no key holds up: rows dealt by ranges of (keys, order), and what each range owes to those before.

A range has its rows in order and is one task's work, whatever share of them one key has. Within ranges the scan is a
window; across ranges it is a window over one row for each key and range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written


def ranged(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """rows with _part, rising with (keys, order), written: rows that are equal in these lie in one range."""
    return written(rows.repartitionByRange(*keys, order).withColumn("_part", F.spark_partition_id()), "ranges")


def within(keys: list[str], *order) -> Window:
    """The rows of a key in a range, in order."""
    return Window.partitionBy("_part", *keys).orderBy(*order)


def carried(placed: DataFrame, keys: list[str], **carries: tuple[Column, str]) -> DataFrame:
    """placed with what comes over from earlier ranges of the same key, for each name an aggregate and how to go on:

    sum adds the aggregates of all earlier ranges (NULL without one), last takes that of the latest that is not NULL.
    Null keys are keys like any other.
    """
    found = placed.groupBy("_part", *keys).agg(*[agg.alias(f"_{name}") for name, (agg, _) in carries.items()])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    go_on = {"sum": F.sum, "last": lambda c: F.last(c, ignorenulls=True)}
    owed = found.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], *[go_on[how](f"_{name}").over(before).alias(name) for name, (_, how) in carries.items()])
    # Only a key that began in an earlier range is owed anything, and a range begins with at most one such key.
    owed = F.broadcast(owed.where(reduce(lambda x, y: x | y, [F.col(name).isNotNull() for name in carries])))
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)], F.col("_part") == F.col("_p"))
    return placed.join(owed, same, "left").drop("_p", *[f"_key{i}" for i in range(len(keys))])
