"""Deterministic splits, caps, samples and quotas by the order of a keyed hash."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.operators.ranks import global_positions
from curatrix.session import materialize


def hash_order(*parts: Column, seed: str = "") -> Column:
    """Sort key: SHA-256 of the parts and the seed."""
    return F.sha2(F.concat_ws("|", *parts, F.lit(seed)), 256)


def half_even(count: Column, share: float) -> Column:
    """``share`` of a count, rounded half to even."""
    return F.bround(count.cast("double") * F.lit(float(share))).cast("long")


def rank_in_group(df: DataFrame, group: str, order: list[str], name: str = "rank", most: int = 1_000_000) -> DataFrame:
    """1-based rank of each row within its group, for groups of any size.

    Groups of at most ``most`` rows (checked) use a window; if one is larger, all rows
    are ranked by the distributed sort, and the first position of the group is
    subtracted. ``order`` should end in a unique column.
    """
    largest = df.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    if largest <= most:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long"))
    placed = global_positions(df, [group, *order], "__rank_at")
    first = placed.groupBy(F.col(group).alias("__rank_group")).agg(F.min("__rank_at").alias("__rank_first"))
    joined = placed.join(first, F.col(group).eqNullSafe(F.col("__rank_group")))
    return joined.withColumn(name, F.col("__rank_at") - F.col("__rank_first") + 1).drop("__rank_at", "__rank_first", "__rank_group")


def rank_class(df: DataFrame, group: str, order: list[str], cuts: list[Column], name: str = "class", most: int = 1_000_000) -> DataFrame:
    """Number of ``cuts`` that a row's rank within its group passes, for groups of any size, without a sort of all rows.

    ``order`` begins with a string of evenly spread hex digits (a hash); the cuts are
    ascending counts, of the group's size ``__n``. Rows are counted by group and the first
    four digits; the counts tell the class of all but the rows whose digits a cut falls
    into, and only those are ranked, so no more than counts is shuffled.
    """
    spark, n = df.sparkSession, len(cuts)
    digits = F.substring(order[0], 1, 4)
    bins = df.groupBy(F.col(group).alias("__group"), digits.alias("__bin")).agg(F.count(F.lit(1)).alias("__rows"))
    whole = Window.partitionBy("__group")  # at most 65,536 bins
    last = F.sum("__rows").over(whole.orderBy("__bin"))
    bins = bins.select("__group", "__bin", "__rows", last.alias("__last"), F.sum("__rows").over(whole).alias("__n"))
    at = [F.min(F.when(F.col("__last") > c, F.struct("__bin", (F.col("__last") - F.col("__rows")).alias("before"), c.alias("cut")))).alias(f"__cut{i}") for i, c in enumerate(cuts)]
    cut = materialize(bins.groupBy("__group").agg(*at), "cuts")  # a cut falls into the first bin that ends after it
    few = cut.count() <= 100_000
    rows = df.withColumn("__bin", digits).join(F.broadcast(cut) if few else cut, F.col(group).eqNullSafe(F.col("__group")))
    inside = reduce(or_, (F.coalesce(F.col("__bin") == F.col(f"__cut{i}.__bin"), F.lit(False)) for i in range(n)))
    passed = lambda one: sum((F.coalesce(one(i), F.lit(False)).cast("int") for i in range(n)), F.lit(0))
    plain = rows.where(~inside).withColumn(name, passed(lambda i: F.col("__bin") > F.col(f"__cut{i}.__bin")))
    torn = materialize(rows.where(inside).withColumn("__torn", F.struct(group, "__bin")), "torn")
    ranked = rank_in_group(torn, "__torn", order, "__rank", most)
    torn = ranked.withColumn(name, passed(lambda i: (F.col("__bin") > F.col(f"__cut{i}.__bin")) | ((F.col("__bin") == F.col(f"__cut{i}.__bin")) & (F.col("__rank") + F.col(f"__cut{i}.before") > F.col(f"__cut{i}.cut")))))
    torn = materialize(torn.select(*plain.columns), "torn")
    return plain.unionByName(torn).drop("__bin", "__group", *(f"__cut{i}" for i in range(n)))


def hash_split(df: DataFrame, key: str, group: str, share: float = 0.1, seed: str = "", name: str = "split", most: int = 100_000) -> DataFrame:
    """Within each group, in hash order: the first ``round(share * n)`` rows are val, as many more test, the rest train.

    Needs one row for each unit that must stay together. Rounding is half to even. The
    columns of the input are kept; ``name`` is replaced. Groups of at most ``most`` rows
    (checked) are ranked; if one is larger, only the rows near the cuts are.
    """
    rows = df.drop(name).withColumn("__h", hash_order(F.col(key), seed=seed))
    if (rows.groupBy(group).count().agg(F.max("count")).first()[0] or 0) > most:
        cut = half_even(F.col("__n"), share)
        placed = rank_class(rows, group, ["__h", key], [cut, 2 * cut], "__class")
        return placed.withColumn(name, F.element_at(F.array(*map(F.lit, ("val", "test", "train"))), F.col("__class") + 1)).drop("__h", "__class")
    ranked = rank_in_group(rows, group, ["__h", key], "__rank")
    sizes = ranked.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).withColumnRenamed(group, "__group")
    cut = half_even(F.col("__n"), share)
    split = F.when(F.col("__rank") <= cut, "val").when(F.col("__rank") <= 2 * cut, "test").otherwise("train")
    joined = ranked.join(sizes, F.col(group).eqNullSafe(F.col("__group")))
    return joined.withColumn(name, split).drop("__h", "__rank", "__n", "__group")


def mapped_split(df: DataFrame, group: str, mapping: dict[str, str], name: str = "split") -> DataFrame:
    """Split of each row by a fixed map of groups; a group that isn't in it raises."""
    value = F.raise_error(F.concat(F.lit("no split for group "), F.coalesce(F.col(group), F.lit("null")))).cast("string")
    for g, s in mapping.items():
        value = F.when(F.col(group) == g, F.lit(s)).otherwise(value)
    return df.withColumn(name, value)


def pinned_split(df: DataFrame, when: Column, split: str = "train", name: str = "split") -> DataFrame:
    """Rows that fulfil the condition get the split whatever they had."""
    return df.withColumn(name, F.when(F.coalesce(when, F.lit(False)), F.lit(split)).otherwise(F.col(name)))


def keep_first(df: DataFrame, key: str, cap: int, seed: str = "") -> DataFrame:
    """Add ``kept``: whether the row is among the first ``cap`` in hash order.

    The cap may be a share of all rows, so rows are counted by the first digits of the
    hash and only those near the cap are ranked. Exactly ``cap`` rows are kept if there
    are as many, also where keys repeat.
    """
    if cap <= 0:
        return df.withColumn("kept", F.lit(False))
    rows = df.withColumns({"__h": hash_order(F.col(key), seed=seed), "__all": F.lit(0)})
    placed = rank_class(rows, "__all", ["__h", key], [F.lit(cap).cast("long")], "__class")
    return placed.withColumn("kept", F.col("__class") == 0).drop("__h", "__all", "__class")


def synthetic_cap(df: DataFrame, key: str, synthetic: Column, in_train: Column, ratio: int = 3, seed: str = "", reason: str = "baseline_synthetic_cap") -> DataFrame:
    """Keep at most one synthetic row of train for each ``ratio`` real ones, in hash order; the others get ``exclusion_reason``."""
    rows = df.withColumns({"__s": F.coalesce(synthetic & in_train, F.lit(False)), "__r": F.coalesce(~synthetic & in_train, F.lit(False))})
    rows = materialize(rows, "cap")
    cap = int(rows.agg(F.floor(F.count_if("__r") / ratio)).first()[0] or 0)
    kept = keep_first(rows.where("__s"), key, cap, seed).withColumn("exclusion_reason", F.when(~F.col("kept"), F.lit(reason)))
    return rows.where("not __s").withColumn("exclusion_reason", F.lit(None).cast("string")).unionByName(kept.drop("kept")).drop("__s", "__r")


def hash_sample(df: DataFrame, key: str, size: int, seed: str = "") -> DataFrame:
    """``size`` rows in hash order of the key (a uniform sample without replacement that reruns repeat)."""
    return df.withColumn("__h", hash_order(F.col(key), seed=seed)).orderBy("__h", key).limit(size).drop("__h")


def quota_sample(df: DataFrame, key: str, category: str, quotas: dict[str, int], seed: str = "") -> DataFrame:
    """Take each category's quota in the order of ``quotas``; a key taken for one category isn't taken for a later one.

    Returns the chosen rows with ``draw`` (rank of the final shuffle is left to the
    reader: ``order by sha2(key|seed)``). Each step is a top-k over the rows left by an
    anti join with the keys taken so far, of which there are at most the sum of quotas.
    """
    taken, out = None, None
    for name, quota in quotas.items():
        rest = df.where(F.col(category) == name)
        if taken is not None:
            rest = rest.join(F.broadcast(taken), key, "left_anti")  # bounded by the quotas
        got = materialize(hash_sample(rest.dropDuplicates([key]), key, quota, f"{seed}|{name}"), "quota")
        taken = got.select(key) if taken is None else taken.union(got.select(key))
        out = got if out is None else out.unionByName(got)
    return out


def quota_shortfall(sample: DataFrame, category: str, quotas: dict[str, int]) -> DataFrame:
    """``category, quota, taken, shortfall`` of a quota sample."""
    spark = sample.sparkSession
    asked = spark.createDataFrame(list(quotas.items()), f"{category} string, quota int")
    got = sample.groupBy(category).agg(F.count(F.lit(1)).alias("taken"))
    n = F.coalesce("taken", F.lit(0))
    return asked.join(got, category, "left").select(category, "quota", n.alias("taken"), F.greatest(F.col("quota") - n, F.lit(0)).alias("shortfall"))


def candidate_index(labels: DataFrame, classes: DataFrame, image: str, label: str, forbidden: list[str], *excluded: DataFrame) -> DataFrame:
    """``category, image, matched``: images with a class of the category, none of the forbidden labels, and in no excluded table.

    ``classes(category, label)`` is a small table of wanted labels (its size is checked
    for the broadcast); ``matched`` lists the labels that made the match, sorted.
    """
    wanted = F.broadcast(classes) if classes.count() <= 100_000 else classes
    hits = labels.join(wanted, label).groupBy("category", image).agg(F.array_join(F.array_sort(F.collect_set(label)), ";").alias("matched"))
    barred = labels.where(F.col(label).isin(forbidden)).select(image).distinct()
    for keys in (barred, *excluded):
        hits = hits.join(keys.select(image), image, "left_anti")
    return hits
