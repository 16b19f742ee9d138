"""Counts, distributions, completeness, pairing and leakage reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.text import is_blank
from curatrix.operators.ranks import global_positions


def totals(df: DataFrame, flags: dict[str, Column] | None = None, sums: dict[str, Column] | None = None) -> DataFrame:
    """One row: ``row_count``, how often each flag holds, and each sum (0 over no rows)."""
    counted = [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in (flags or {}).items()]
    added = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in (sums or {}).items()]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *counted, *added)


def distribution(df: DataFrame, *by: str, keep_null: bool = False) -> DataFrame:
    """Rows for each value, as ``row_count``, most frequent first, ties by value; nulls are left out unless kept."""
    rows = df if keep_null else df.where(" and ".join(f"`{c}` is not null" for c in by))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("row_count"), *(F.asc_nulls_last(c) for c in by))


def top_values(df: DataFrame, by: str, k: int = 15) -> DataFrame:
    return distribution(df, by).limit(k)


def distinct_counts(df: DataFrame, *cols: str) -> DataFrame:
    """One row: exact number of distinct non-null values of each column, as ``<column>_distinct``."""
    return df.agg(*(F.count_distinct(c).alias(f"{c}_distinct") for c in cols))


def spanning_keys(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value: ``key, distinct_values, row_count``. Nulls count neither as key nor as value.

    Keys and values are counted in two steps, so a frequent key is reduced map-side.
    """
    pairs = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias("distinct_values"), F.sum("n").alias("row_count")).where("distinct_values > 1")


def count_and_sum(df: DataFrame, by: str, value: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(value), F.lit(0)).alias(f"{value}_sum"))


def members(df: DataFrame, key: str, member: str, least: int = 1) -> DataFrame:
    """Sorted array of the distinct members of each key with at least ``least`` of them.

    The array of a key is one value, so this is for keys of a bounded size (files of one
    digest, variants of one source); ``dedup.exact_groups`` gives large groups as rows.
    """
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(member)).alias("members")).where(F.size("members") >= least)


def count_of_counts(df: DataFrame, key: str) -> DataFrame:
    """How many keys occur how often: ``occurrences, keys``; null is no key."""
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("occurrences"))
    return sizes.groupBy("occurrences").agg(F.count(F.lit(1)).alias("keys"))


def completeness(df: DataFrame, *cols: str) -> DataFrame:
    """``field, present, missing`` for each column in one pass; blank text is missing."""
    lines = [F.struct(F.lit(c).alias("field"), F.count_if(~is_blank(F.col(c))).alias("present"), F.count_if(is_blank(F.col(c))).alias("missing")) for c in cols]
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def agreement(df: DataFrame, key: str, *signatures: str, least: int = 2) -> DataFrame:
    """For each key with at least ``least`` rows whether all rows agree in each signature: ``key, row_count, same_<signature>``.

    Null counts as a value of its own. Minimum and maximum decide, which needs no list of a group.
    """
    same = [(F.min(F.struct(F.col(s))) == F.max(F.struct(F.col(s)))).alias(f"same_{s}") for s in signatures]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"), *same).where(F.col("row_count") >= least)


def share_of(df: DataFrame, flag: Column, name: str = "share") -> DataFrame:
    """One row: share of the rows for which the flag holds, 0 over no rows."""
    return df.agg(F.coalesce(F.avg(F.when(flag, 1.0).otherwise(0.0)), F.lit(0.0)).alias(name))


def pair_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Unordered pairs of values: ``first, second, row_count``."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.least(a, b).alias("first"), F.greatest(a, b).alias("second")).agg(F.count(F.lit(1)).alias("row_count"))


def membership_counts(df: DataFrame, key: str, value: str, values: list[str]) -> DataFrame:
    """For each key how many of its rows have each of the given values (a pivot without a second pass)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*(F.count_if(F.col(value) == v).alias(f"in_{v}") for v in values))


def error_summary(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: pairs, and the smallest, largest and mean absolute difference of two columns."""
    d = F.abs(F.col(a) - F.col(b))
    return df.agg(F.count(d).alias("pairs"), F.min(d).alias("min_abs"), F.max(d).alias("max_abs"), F.avg(d).alias("mean_abs"))


def pairing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every key of either side with its state: ``paired``, ``missing`` (left only) or ``orphan`` (right only).

    Null keys are left out; repeated keys count once.
    """
    a = left.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_a", F.lit(True))
    b = right.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_b", F.lit(True))
    state = F.when(F.col("_a") & F.col("_b"), "paired").when(F.col("_a"), "missing").otherwise("orphan")
    return a.join(b, key, "full_outer").select(key, state.alias("state"))


def split_overlap(df: DataFrame, key: str, split: str) -> DataFrame:
    """Keys that two splits share, counted for each pair of splits: ``split_a, split_b, shared_keys``.

    A key has at most as many rows as there are splits when they are paired.
    """
    once = df.where(F.col(key).isNotNull() & F.col(split).isNotNull()).select(key, split).distinct()
    pairs = once.withColumnRenamed(split, "split_a").join(once.withColumnRenamed(split, "split_b"), key).where("split_a < split_b")
    return pairs.groupBy("split_a", "split_b").agg(F.count(F.lit(1)).alias("shared_keys"))


def absent_count(images: DataFrame, annotations: DataFrame, key: str) -> DataFrame:
    """One row: images in all, and those without an annotation."""
    known = annotations.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_has", F.lit(True))
    return images.select(key).join(known, key, "left").agg(F.count(F.lit(1)).alias("images"), F.count_if(F.col("_has").isNull()).alias("negatives"))


def evenly_spaced(df: DataFrame, order: str, picks: int) -> DataFrame:
    """``picks`` rows at even distances of the order, the first and the last among them; all rows if there are fewer.

    Positions are those of ``linspace(0, n - 1, picks)`` cut off to whole numbers.
    """
    placed = global_positions(df, [order], "position")
    n = placed.count()
    if n <= picks:
        return placed
    spots = sorted({int(i * (n - 1) / (picks - 1)) for i in range(picks)}) if picks > 1 else [0]
    return placed.where(F.col("position").isin(spots))
