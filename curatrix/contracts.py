"""Data contracts: each check raises ``ContractError`` with what is wrong, or gives back its table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.session import materialize


class ContractError(ValueError):
    """The data break a stated rule."""


def _fail_if(rows: DataFrame, what: str, show: int = 5) -> None:
    bad = [tuple(r) for r in rows.limit(show).collect()]
    if bad:
        raise ContractError(f"{what}: {bad}")


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {missing}")
    return df


def require_counts(df: DataFrame, expected: dict[str, tuple[Column | None, int]]) -> DataFrame:
    """Each named count (of the rows for which the condition holds, or of all) must be as expected; one pass."""
    found = df.agg(*(F.count(F.lit(1)).alias(n) if c is None else F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, (c, _) in expected.items())).first()
    wrong = {n: (found[n], e) for n, (_, e) in expected.items() if found[n] != e}
    if wrong:
        raise ContractError(f"counts (found, expected): {wrong}")
    return df


def require_unique(df: DataFrame, key: list[str], what: str = "rows") -> DataFrame:
    _fail_if(df.groupBy(*key).count().where("count > 1").select(*key, "count"), f"repeated keys in {what}")
    return df


def require_complete(df: DataFrame, columns: list[str]) -> DataFrame:
    """No nulls in the columns, e.g. after a left join."""
    found = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns)).first().asDict()
    wrong = {c: n for c, n in found.items() if n}
    if wrong:
        raise ContractError(f"missing values: {wrong}")
    return df


def require_domain(df: DataFrame, column: str, allowed: list[str], nullable: bool = False) -> DataFrame:
    """Values outside the domain fail; so does null unless allowed."""
    out = ~F.col(column).isin(allowed) if nullable else F.coalesce(~F.col(column).isin(allowed), F.lit(True))
    _fail_if(df.where(out).groupBy(column).count(), f"values of {column} outside {allowed}")
    return df


def require_none(df: DataFrame, condition: Column, what: str) -> DataFrame:
    """No row may fulfil the condition (e.g. a negative image with boxes)."""
    _fail_if(df.where(condition), what)
    return df


def integral(value: Column) -> Column:
    """Whether a number is finite and whole."""
    x = value.cast("double")
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")) & (x == F.floor(x)), F.lit(False))


def policy_violations(df: DataFrame, split: str = "split", group: str = "source_group", digest: str = "pixel_sha256", synthetic_share: float = 0.25, near_pairs: DataFrame | None = None, key: str = "canonical_id", status: str = "status", few: int = 200_000) -> DataFrame:
    """``rule, violations`` for the split rules; a table that keeps them has 0 everywhere.

    ``synthetic_in_eval``: rows of val or test that aren't REAL. ``train_only_in_eval``:
    TRAIN_ONLY rows outside train. ``synthetic_share``: 1 if synthetic rows are a larger
    share of train than allowed. ``group_in_several`` and ``pixels_in_several``: groups
    and digests that stand in more than one split. With ``near_pairs`` (two columns of
    keys and a status) ``unresolved_near_pairs``: pairs without a decision (blank, null or
    "unsure") whose two records have different splits; a missing table of pairs is an
    empty one. Needs ``real_synthetic`` and ``allowed_split`` besides the named columns;
    rows without a split are ignored. The keys that open pairs name are broadcast if there
    are at most ``few``.
    """
    rows = df.where(F.col(split).isin("train", "val", "test"))
    out = F.col(split) != "train"
    flat = rows.agg(
        F.count_if(out & (F.col("real_synthetic") != "REAL")).alias("a"),
        F.count_if(out & (F.col("allowed_split") == "TRAIN_ONLY")).alias("b"),
        F.coalesce((F.try_divide(F.count_if(~out & (F.col("real_synthetic") == "SYNTHETIC")), F.count_if(~out)) > synthetic_share).cast("long"), F.lit(0)).alias("c"),
    ).select(F.expr("stack(3, 'synthetic_in_eval', a, 'train_only_in_eval', b, 'synthetic_share', c) as (rule, violations)"))
    bit = F.when(~out, 1).when(F.col(split) == "val", 2).otherwise(4)
    for name, shared in (("group_in_several", group), ("pixels_in_several", digest)):
        spans = rows.where(F.col(shared).isNotNull()).groupBy(shared).agg(F.bit_count(F.bit_or(bit)).alias("splits")).where("splits > 1")
        flat = flat.unionByName(spans.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("violations")))
    if near_pairs is not None:
        a, b = [c for c in near_pairs.columns if c != status][:2]
        open_pairs = near_pairs.where(F.coalesce(F.lower(F.trim(status)), F.lit("")).isin("", "unsure")).select(F.col(a).alias("_a"), F.col(b).alias("_b"))
        open_pairs = materialize(open_pairs, "open")
        own, named = rows.select(F.col(key).alias("_k"), F.col(split).alias("_s")), open_pairs.select(F.explode(F.array("_a", "_b")).alias("_k")).distinct()
        named = materialize(named, "named")
        if named.count() <= few:  # only rows that a pair names are shuffled
            own = own.join(F.broadcast(named), "_k", "left_semi")
        both = open_pairs.join(own.toDF("_a", "_sa"), "_a").join(own.toDF("_b", "_sb"), "_b").where("_sa <> _sb")
        flat = flat.unionByName(both.agg(F.lit("unresolved_near_pairs").alias("rule"), F.count(F.lit(1)).alias("violations")))
    return flat


def physical_problems(expected: DataFrame, files: DataFrame, key: str, digest: str, root: str, suffixes: list[str]) -> DataFrame:
    """All that is wrong between a manifest and the files of ``root``, collected: ``key, problem``.

    ``expected(key, digest)`` and ``files(path, sha256)``, a recursive listing with
    digests. Problems: those of ``identity_differences`` by the file's stem, ``nested``
    (a file in a folder below the root), ``extension`` (none of the suffixes) and
    ``repeated`` (two files of one stem).
    """
    from curatrix.functions.text import stem, suffix

    inside = F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), f"^{re.escape(re.sub('^file:/+', '/', root).rstrip('/'))}/", "")
    rows = files.select(stem(F.col("path")).alias(key), suffix(F.col("path")).alias("_x"), F.contains(inside, F.lit("/")).alias("_n"), F.lower("sha256").alias(digest))
    per_file = rows.select(key, F.explode(F.array_compact(F.array(F.when(F.col("_n"), "nested"), F.when(~F.col("_x").isin(suffixes), "extension")))).alias("problem"))
    repeated = rows.groupBy(key).count().where("count > 1").select(key, F.lit("repeated").alias("problem"))
    one = rows.groupBy(key).agg(F.min(digest).alias(digest))
    wanted = expected.select(F.col(key).cast("string").alias(key), F.lower(digest).alias(digest))
    return per_file.unionByName(repeated).unionByName(identity_differences(wanted, one, key, digest)).distinct()


def require_unchanged(df: DataFrame, columns: list[str], pinned: tuple[int, str]) -> DataFrame:
    """A table that must not change (a cache): its rows and ``table_digest`` must be the pinned ones."""
    from curatrix.functions.hashing import table_digest

    found = df.agg(*table_digest(*columns)).first()
    if tuple(found) != tuple(pinned):
        raise ContractError(f"table changed (found, pinned): {tuple(found)}, {tuple(pinned)}")
    return df


def require_policy(df: DataFrame, **columns) -> DataFrame:
    _fail_if(policy_violations(df, **columns).where("violations > 0"), "split policy")
    return df


def identity_differences(expected: DataFrame, found: DataFrame, key: str, digest: str) -> DataFrame:
    """Manifest against files: ``key, problem`` with ``missing``, ``unexpected`` or ``changed``."""
    a, b = expected.select(key, F.col(digest).alias("_e")), found.select(key, F.col(digest).alias("_f"))
    both = a.withColumn("_a", F.lit(True)).join(b.withColumn("_b", F.lit(True)), key, "full_outer")
    problem = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "unexpected").when(~F.col("_e").eqNullSafe(F.col("_f")), "changed")
    return both.select(key, problem.alias("problem")).where("problem is not null")


def require_same_set(expected: DataFrame, found: DataFrame, key: str, show: int = 5) -> None:
    """Both tables must have the same keys; the error lists the first missing and extra ones."""
    a, b = expected.select(key).distinct(), found.select(key).distinct()
    missing, extra = ([r[0] for r in x.join(y, key, "left_anti").orderBy(key).limit(show).collect()] for x, y in ((a, b), (b, a)))
    if missing or extra:
        raise ContractError(f"missing {missing}, extra {extra}")


def require_digest(df: DataFrame, digest: Column, pinned: str) -> DataFrame:
    """Every row's digest must be the pinned one, letter case aside."""
    return require_none(df, F.coalesce(F.lower(digest) != pinned.lower(), F.lit(True)), "digest")


def require_frozen(selection: dict, needed: dict[str, object], forbidden: list[str] = ()) -> dict:
    """Before a one-shot stage: the selection must have the needed entries, and none of the forbidden ones may be set."""
    wrong = {k: (selection.get(k), v) for k, v in needed.items() if selection.get(k) != v}
    early = [k for k in forbidden if selection.get(k)]
    if wrong or early:
        raise ContractError(f"selection (found, needed): {wrong}; too early: {early}")
    return selection
