"""Set operations on tables and on keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*tables: DataFrame, tag: str | None = None, names: list[str] | None = None) -> DataFrame:
    """All rows with the union of the columns (missing ones null); ``tag`` names the table of each row."""
    if tag:
        tables = tuple(t.withColumn(tag, F.lit(n)) for t, n in zip(tables, names or map(str, range(len(tables)))))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def key_sets(a: DataFrame, b: DataFrame, key: str) -> dict[str, DataFrame]:
    """Distinct keys of the difference, intersection and union."""
    x, y = a.select(key), b.select(key)
    return {"difference": x.subtract(y), "intersection": x.intersect(y), "union": x.union(y).distinct()}


def symmetric_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of only one side with ``side`` = left or right; empty if the sets are equal."""
    x, y = (d.select(key).where(F.col(key).isNotNull()).distinct() for d in (a, b))
    left = x.join(y, key, "left_anti").withColumn("side", F.lit("left"))
    return left.unionByName(y.join(x, key, "left_anti").withColumn("side", F.lit("right")))
