"""Review state: decision logs, migration of group decisions, accepted views and adjudication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.contracts import ContractError

UNDECIDED = ["", "unsure"]


def latest_decisions(log: DataFrame, key: str, status: str, at: str, tie: str | None = None) -> DataFrame:
    """Latest status of each key: ``key, status, at``; of decisions at one moment the largest ``tie`` (or status) counts.

    An aggregation, so a key with many decisions is reduced map-side.
    """
    order = F.struct(F.col(at), F.col(tie or status))
    return log.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(status, order).alias(status), F.max(at).alias(at))


def is_reviewed(status: Column) -> Column:
    """Blank, null and "unsure" are not reviewed."""
    return ~F.coalesce(F.lower(F.trim(status)), F.lit("")).isin(UNDECIDED)


def first_unreviewed(items: DataFrame, decisions: DataFrame, key: str, status: str, position: str) -> DataFrame:
    """One row: the smallest position without a decision, null if all are reviewed."""
    state = items.join(decisions.select(key, status), key, "left")
    return state.where(~is_reviewed(F.col(status))).agg(F.min(position).alias("first_unreviewed"))


def migrate_group_decisions(variants: DataFrame, groups: DataFrame, group: str, status: str) -> DataFrame:
    """Copy a group's decision to its only variant unless that is decided already; groups of several variants get none."""
    sizes = variants.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    decided = groups.where(is_reviewed(F.col(status))).groupBy(group).agg(F.max(status).alias("_from"))
    own = F.when(F.coalesce(F.trim(status), F.lit("")) != "", F.col(status))
    out = variants.join(sizes, group, "left").join(decided, group, "left")
    return out.withColumn(status, F.coalesce(own, F.when(F.col("_n") == 1, F.col("_from")), F.lit(""))).drop("_n", "_from")


def accepted_view(metadata: DataFrame, decisions: DataFrame, key: str, status: str, accepted: str) -> DataFrame:
    """Metadata of the accepted keys with their status."""
    kept = decisions.where(F.col(status) == accepted).select(key, status).distinct()
    return metadata.drop(status).join(kept, key)


def until_target(log: DataFrame, order: list[str], accepted: Column, target: int) -> DataFrame:
    """The log up to the decision that reaches the target (all of it if none does).

    Only accepted rows are put in order, and of them only ``target`` (a top-k).
    """
    last = log.where(accepted).orderBy(*order).limit(target)
    row = last.agg(F.count(F.lit(1)).alias("n"), F.max(F.struct(*order)).alias("at")).first()
    if row["n"] < target:
        return log
    stop = F.struct(*(F.lit(v).alias(c) for c, v in zip(order, row["at"])))
    return log.where(F.struct(*order) <= stop)


def sufficiency(accepted: Column, least: int = 500, most: int = 1000) -> Column:
    """Verdict on a number of accepted rows."""
    return F.when(accepted < least, "not_sufficient").when(accepted <= most, "satisfied").otherwise("review_required")


def adjudicate(groups: DataFrame, group: str, first: str, second: str, keep: str) -> DataFrame:
    """``group, keep, exclude`` of pairs of which one is kept.

    Raises for an unresolved row (``keep`` blank or neither id), and for an id that one
    pair keeps and another excludes.
    """
    bad = groups.where(F.coalesce(~F.col(keep).isin(F.col(first), F.col(second)), F.lit(True)))
    if unresolved := [r[0] for r in bad.select(group).limit(5).collect()]:
        raise ContractError(f"unresolved groups: {unresolved}")
    out = groups.select(group, F.col(keep).alias("keep_id"), F.when(F.col(keep) == F.col(first), F.col(second)).otherwise(F.col(first)).alias("exclude_id"))
    both = out.select(F.col("keep_id").alias("id")).intersect(out.select(F.col("exclude_id").alias("id")))
    if clash := [r[0] for r in both.limit(5).collect()]:
        raise ContractError(f"kept and excluded: {clash}")
    return out


def assess_duplicates(rows: DataFrame, digest: str, sequence: str, signature: str) -> DataFrame:
    """Verdict on each repeated digest: one sequence and equal boxes, one sequence and other boxes, or several sequences."""
    same = lambda c: F.min(F.struct(F.col(c))) == F.max(F.struct(F.col(c)))
    per = rows.where(F.col(digest).isNotNull()).groupBy(digest).agg(F.count(F.lit(1)).alias("members"), same(sequence).alias("same_sequence"), same(signature).alias("same_boxes"))
    verdict = F.when(F.col("same_sequence") & F.col("same_boxes"), "repeated_frame").when(F.col("same_sequence"), "repeated_frame_boxes_differ").otherwise("across_sequences")
    return per.where("members >= 2").withColumn("verdict", verdict)


def variant_analysis(rows: DataFrame, group: str, digest: str, signature: str) -> DataFrame:
    """Groups of several variants: whether all pixels are equal, and whether the boxes disagree."""
    per = rows.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("variants"), F.count_distinct(digest).alias("pixel_versions"), F.count_distinct(signature).alias("box_versions")
    )
    return per.where("variants >= 2").withColumns({"identical_pixels": F.col("pixel_versions") == 1, "boxes_disagree": F.col("box_versions") > 1})


def replica_check(stems: DataFrame, files: DataFrame, stem: str, folder: str, folders: list[str]) -> DataFrame:
    """For each stem and folder whether the file is there: ``stem, folder, present``."""
    want = stems.select(stem, F.explode(F.array(*map(F.lit, folders))).alias(folder))
    have = files.select(stem, folder).distinct().withColumn("present", F.lit(True))
    return want.join(have, [stem, folder], "left").na.fill(False, ["present"])


def flag_repeats(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``repeat`` for all rows of a key but the first, ``repeated`` for all of a key that occurs more than once.

    Counts and first rows are aggregated and joined back, so a key of any size is spread.
    """
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*order)).alias("_first"))
    out = df.join(first, key, "left")
    several = F.coalesce(F.col("_n") > 1, F.lit(False))
    return out.withColumns({"repeated": several, "repeat": several & (F.struct(*order) > F.col("_first"))}).drop("_n", "_first")


def index_in_group(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``variant_index`` from 1 and ``variant_count`` within groups of bounded size (variants of one source)."""
    w = Window.partitionBy(group)
    return df.withColumns({"variant_index": F.row_number().over(w.orderBy(*order)), "variant_count": F.count(F.lit(1)).over(w)})
