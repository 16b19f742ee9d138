"""Joins with the cardinality and completeness checks that pandas' ``validate`` gives, and lookup joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.contracts import require_complete, require_unique


def checked_left_join(left: DataFrame, right: DataFrame, on: list[str], validate: str = "one_to_one", required: list[str] | None = None) -> DataFrame:
    """Left join that raises unless the keys are unique (both sides, or the right for ``many_to_one``) and the ``required`` columns are filled.

    Each check is one aggregation over the keys. Other columns of the right side that the left has too are dropped.
    """
    if validate not in ("one_to_one", "many_to_one"):
        raise ValueError(validate)
    if validate == "one_to_one":
        require_unique(left, on, "left")
    require_unique(right, on, "right")
    extra = [c for c in right.columns if c in on or c not in left.columns]
    out = left.join(right.select(*extra), on, "left")
    if required:
        require_complete(out, required)
    return out


def semi(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is among the keys."""
    return df.join(keys.select(*([on] if isinstance(on, str) else on)), on, "left_semi")


def anti(df: DataFrame, on: str, *excluded: DataFrame) -> DataFrame:
    """Rows whose key is in none of the excluded tables; a null key stays."""
    for keys in excluded:
        df = df.join(keys.select(on).where(F.col(on).isNotNull()), on, "left_anti")
    return df


def lookup(df: DataFrame, table: DataFrame, on: str, value: str, unknown: str = "UNKNOWN_") -> DataFrame:
    """Add ``value`` of the table by key; a key without an entry gives ``unknown`` and the key, a null key just ``unknown``."""
    entries = table.where(F.col(on).isNotNull()).groupBy(on).agg(F.min(value).alias(value))
    name = F.coalesce(F.col(value), F.concat(F.lit(unknown), F.coalesce(F.col(on).cast("string"), F.lit(""))))
    return df.drop(value).join(entries, on, "left").withColumn(value, name)


def upstream_splits(df: DataFrame, index: DataFrame, on: str, split: str, order: list[str]) -> DataFrame:
    """Each key's upstream splits as an array in the given order, with ``found`` and ``several`` flags."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, order)), F.col(split)), F.lit(0)).cast("int")
    per = index.where(F.col(on).isNotNull() & F.col(split).isNotNull()).select(on, split, rank.alias("_r")).distinct()
    per = per.groupBy(on).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", split))), lambda x: x[split]).alias("splits"))
    out = df.join(per, on, "left")
    return out.withColumns({"found": F.col("splits").isNotNull(), "several": F.coalesce(F.size("splits") > 1, F.lit(False))})


def in_order_of(df: DataFrame, review: DataFrame, on: str, position: str) -> DataFrame:
    """The rows in the order of another table's positions; rows that it doesn't have come last, by key."""
    return df.join(review.select(on, position), on, "left").orderBy(F.asc_nulls_last(position), on)


def first_existing(candidates: DataFrame, files: DataFrame, key: str, path: str, priority: str) -> DataFrame:
    """For each key the candidate path of the lowest priority number that exists; null where none does."""
    hits = candidates.join(files.select(path).distinct(), path)
    best = hits.groupBy(key).agg(F.min_by(path, F.struct(priority, path)).alias(path))
    return candidates.select(key).distinct().join(best, key, "left")
