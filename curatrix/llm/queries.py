"""Queries of the training-data operators over their whole tables, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.llm import leak, mix, overlap, quality, quota, sample, split
from curatrix.session import materialize, table

RATE, SEED = 0.1, 7


def _t(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [table(spark, folder, n) for n in names]


def p1_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sample.stable_sample(*_t(spark, folder, "baseline_split_manifest"), RATE, SEED)


def p1_group_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sample.stable_sample(*_t(spark, folder, "baseline_split_manifest"), RATE, SEED, unit="group")


def p1_growth(spark: SparkSession, folder: str) -> DataFrame:
    return sample.growth_report(*_t(spark, folder, "baseline_split_manifest"), RATE, SEED)


def _p2(spark: SparkSession, folder: str) -> DataFrame:
    return split.assignment(*_t(spark, folder, "baseline_split_manifest", "group_links", "split_targets"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return split.torn_records(_p2(spark, folder))


def p2_torn_relations(spark: SparkSession, folder: str) -> DataFrame:
    return split.torn_relations(split.placed_rows(*_t(spark, folder, "baseline_split_manifest", "group_links")))


def p2_assignment(spark: SparkSession, folder: str) -> DataFrame:
    return split.assign_splits(*_t(spark, folder, "baseline_split_manifest", "group_links", "split_targets"))


def p2_invariants(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_invariants(_p2(spark, folder), table(spark, folder, "split_targets"))


def p2_split_report(spark: SparkSession, folder: str) -> DataFrame:
    """Records and shares; how many units a split got is the flow's choice, which SQL cannot state, so it is left to ``split.split_report``."""
    return split.split_report(p2_assignment(spark, folder), table(spark, folder, "split_targets")).drop("units")


def p3_sample(spark: SparkSession, folder: str) -> DataFrame:
    return quota.target_sample(*_t(spark, folder, "accepted_negatives_batch2_metadata", "negative_targets"))


def p3_report(spark: SparkSession, folder: str) -> DataFrame:
    images, targets = _t(spark, folder, "accepted_negatives_batch2_metadata", "negative_targets")
    carried = materialize(quota.carried_values(images, quota.ask_table(targets)), "carried")
    cells = quota.raked_cells(images, targets, carried)
    return quota.sample_report(materialize(quota.target_sample(images, targets, cells=cells), "sample"), images, targets, carried, cells)


def p3_supply(spark: SparkSession, folder: str) -> DataFrame:
    return quota.supply_report(*_t(spark, folder, "accepted_negatives_batch2_metadata", "negative_targets"))


def p3_invariants(spark: SparkSession, folder: str) -> DataFrame:
    images, targets = _t(spark, folder, "accepted_negatives_batch2_metadata", "negative_targets")
    return quota.sample_invariants(materialize(quota.target_sample(images, targets), "sample"), images, targets)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_report(spark, folder).where(~F.col("can_be_met")).select("negative_batch", "target_field", "target_value")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return overlap.overlap_found(overlap.overlap_pairs(*_t(spark, folder, "baseline_split_manifest", "fingerprints")))


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    manifest, prints = _t(spark, folder, "baseline_split_manifest", "fingerprints")
    return overlap.overlap_report(materialize(overlap.overlap_pairs(manifest, prints), "pairs"), manifest)


def p5_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leak.leaks(*_t(spark, folder, "documents", "heldout_items"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_leaks(spark, folder).select("doc_id", "item_id")


def p5_report(spark: SparkSession, folder: str) -> DataFrame:
    return leak.leak_report(p5_leaks(spark, folder), table(spark, folder, "heldout_items"))


def p6_plan_by_length(spark: SparkSession, folder: str) -> DataFrame:
    """The plan with characters in place of tokens, which SQL can count as well."""
    documents, targets = _t(spark, folder, "documents", "mix_targets")
    listed = targets.select(mix.word_key(F.col("source")).alias("source_key")).distinct()
    rows = documents.select(mix.word_key(F.col("source")).alias("source_key"), F.length("text").alias("n")).join(F.broadcast(listed), "source_key", "left_semi")
    totals = rows.groupBy("source_key").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.coalesce("n", F.lit(0))).alias("tokens"))
    plan = mix.mix_plan(totals, targets)
    return plan.select("source", "documents", "tokens", F.round("wanted", 3).alias("wanted"), F.round("planned", 3).alias("planned"), "falls_short")


def p6_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mix.mix(*_t(spark, folder, "documents", "mix_targets"))[0]


def p6_report(spark: SparkSession, folder: str) -> DataFrame:
    return mix.mix_report(*mix.mix(*_t(spark, folder, "documents", "mix_targets")))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return p6_report(spark, folder).where("falls_short").select("source")


def p7_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return quality.text_statistics(*_t(spark, folder, "documents", "common_words"))


def p7_basic(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", quality.language_key(F.col("lang")).alias("lang_key"), *quality.basic_statistics())


def p7_basic_scores(spark: SparkSession, folder: str) -> DataFrame:
    return quality.tail_scores(p7_basic(spark, folder), quality.BASIC).withColumn("score", F.round("score", 6))


def p7_scores(spark: SparkSession, folder: str) -> DataFrame:
    return quality.tail_scores(p7_statistics(spark, folder))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return quality.not_prose(p7_scores(spark, folder)).select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        p1_sample, p1_group_sample, p1_growth, p2_found, p2_torn_relations, p2_assignment, p2_invariants, p2_split_report, p3_sample, p3_report, p3_supply, p3_invariants, p3_found,
        p4_found, p4_report, p5_leaks, p5_found, p5_report, p6_plan_by_length, p6_mixture, p6_report, p6_found, p7_statistics, p7_basic, p7_basic_scores, p7_scores, p7_found,
    ]
    return {f.__name__: f for f in own}
