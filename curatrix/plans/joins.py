"""Join and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.operators import joins, review, sets
from curatrix.plans.registry import Book
from curatrix.session import table

BOOK = Book()


@BOOK.query("""
SELECT c.c_custkey, n.n_name, r.r_name FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def checked_lookup_chain(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, folder, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    out = joins.checked_left_join(c, n, ["n_nationkey"], "many_to_one", ["n_name"])
    out = joins.checked_left_join(out, table(spark, folder, "region").select("r_regionkey", "r_name"), ["r_regionkey"], "many_to_one", ["r_name"])
    return out.select("c_custkey", "n_name", "r_name")


@BOOK.query("""
SELECT s.s_suppkey, coalesce(n.n_name, 'UNKNOWN_' || s.s_nationkey) AS n_name FROM supplier s LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n ON n.n_nationkey = s.s_nationkey
""")
def unknown_labels(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    return joins.lookup(s, table(spark, folder, "nation").where("n_regionkey <> 0"), "n_nationkey", "n_name").select("s_suppkey", "n_name")


@BOOK.query("SELECT canonical_id, avax_split FROM baseline_split_manifest WHERE canonical_id IN (SELECT canonical_id FROM fingerprints WHERE phash IS NOT NULL)")
def accepted_semi(spark: SparkSession, folder: str) -> DataFrame:
    return joins.semi(table(spark, folder, "baseline_split_manifest"), table(spark, folder, "fingerprints").where("phash is not null"), "canonical_id").select("canonical_id", "avax_split")


@BOOK.query("""
SELECT canonical_id, source_dataset FROM baseline_split_manifest m WHERE NOT EXISTS (SELECT 1 FROM fingerprints f WHERE f.canonical_id = m.canonical_id)
  AND NOT EXISTS (SELECT 1 FROM accepted_negatives_batch2_metadata a WHERE 'openimagesneg__' || a.ImageID = m.canonical_id)
""")
def excluded_anti(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "accepted_negatives_batch2_metadata").select(F.concat(F.lit("openimagesneg__"), "ImageID").alias("canonical_id"))
    return joins.anti(table(spark, folder, "baseline_split_manifest"), "canonical_id", table(spark, folder, "fingerprints"), a).select("canonical_id", "source_dataset")


@BOOK.query("SELECT DISTINCT canonical_id FROM baseline_split_manifest WHERE canonical_id NOT IN (SELECT canonical_id FROM fingerprints WHERE canonical_id IS NOT NULL)")
def orphan_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Records without fingerprints."""
    return sets.key_sets(table(spark, folder, "baseline_split_manifest"), table(spark, folder, "fingerprints"), "canonical_id")["difference"]


@BOOK.query("""
SELECT source_group, 'left' AS side FROM (SELECT source_group FROM baseline_split_manifest WHERE source_group IS NOT NULL EXCEPT SELECT source_group FROM fingerprints)
UNION ALL SELECT source_group, 'right' FROM (SELECT source_group FROM fingerprints WHERE source_group IS NOT NULL EXCEPT SELECT source_group FROM baseline_split_manifest)
""")
def set_symmetric_difference(spark: SparkSession, folder: str) -> DataFrame:
    return sets.symmetric_difference(table(spark, folder, "baseline_split_manifest"), table(spark, folder, "fingerprints"), "source_group")


@BOOK.query("SELECT source_group FROM baseline_split_manifest INTERSECT SELECT source_group FROM fingerprints")
def shared_groups(spark: SparkSession, folder: str) -> DataFrame:
    return sets.key_sets(table(spark, folder, "baseline_split_manifest"), table(spark, folder, "fingerprints"), "source_group")["intersection"]


@BOOK.query("""
SELECT canonical_id, source_group, avax_split, NULL::BIGINT AS width, 'manifest' AS origin FROM baseline_split_manifest
UNION ALL SELECT canonical_id, source_group, NULL, width, 'prints' FROM fingerprints
""")
def union_batches(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "baseline_split_manifest").select("canonical_id", "source_group", "avax_split")
    b = table(spark, folder, "fingerprints").select("canonical_id", "source_group", F.col("width").cast("long").alias("width"))
    return sets.union_all(a, b, tag="origin", names=["manifest", "prints"])


@BOOK.query("""
WITH i AS (SELECT DISTINCT ImageID, Subset FROM accepted_negatives_batch2_metadata WHERE ImageID IS NOT NULL AND Subset IS NOT NULL),
k AS (SELECT DISTINCT ImageID FROM accepted_negatives_batch2_metadata WHERE ImageID IS NOT NULL)
SELECT k.ImageID, string_agg(i.Subset, ';' ORDER BY CASE i.Subset WHEN 'train' THEN 1 WHEN 'validation' THEN 2 WHEN 'test' THEN 3 ELSE 0 END) AS splits, count(i.Subset) > 0 AS found, count(i.Subset) > 1 AS several
FROM k LEFT JOIN i USING (ImageID) GROUP BY 1
""")
def upstream_splits(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "accepted_negatives_batch2_metadata").where("ImageID is not null")
    out = joins.upstream_splits(a.select("ImageID").distinct(), a, "ImageID", "Subset", ["train", "validation", "test"])
    return out.withColumn("splits", F.array_join("splits", ";"))


@BOOK.query("""
WITH d AS (SELECT user_id AS k, max_by(event_type, (ts, event_id)) AS status, max(ts)::VARCHAR AS at FROM events WHERE user_id IS NOT NULL GROUP BY 1)
SELECT k AS user_id, status FROM d
""")
def latest_decision(spark: SparkSession, folder: str) -> DataFrame:
    return review.latest_decisions(table(spark, folder, "events"), "user_id", "event_type", "ts", "event_id").select("user_id", F.col("event_type").alias("status"))


@BOOK.query("""
WITH d AS (SELECT ImageID, max_by(ReviewStatus, (ingested_at, coalesce(ReviewStatus, ''))) AS s FROM accepted_negatives_batch2_metadata WHERE ImageID IS NOT NULL GROUP BY 1),
i AS (SELECT ImageID, row_number() OVER (ORDER BY ImageID) AS position FROM d)
SELECT min(position) AS first_unreviewed FROM i JOIN d USING (ImageID) WHERE coalesce(lower(trim(s)), '') IN ('', 'unsure')
""")
def first_unreviewed(spark: SparkSession, folder: str) -> DataFrame:
    from curatrix.operators.ranks import global_positions

    log = table(spark, folder, "accepted_negatives_batch2_metadata").withColumn("tie", F.coalesce("ReviewStatus", F.lit("")))
    d = review.latest_decisions(log, "ImageID", "ReviewStatus", "ingested_at", "tie")
    items = global_positions(d.select("ImageID"), ["ImageID"], "position").withColumn("position", F.col("position") + 1)
    return review.first_unreviewed(items, d, "ImageID", "ReviewStatus", "position")


@BOOK.query("""
WITH v AS (SELECT canonical_id, source_group, CASE WHEN trim(coalesce(split_exclusion_reason, '')) <> '' THEN split_exclusion_reason END AS own FROM baseline_split_manifest WHERE source_group IS NOT NULL),
n AS (SELECT source_group, count(*) AS n FROM v GROUP BY 1),
g AS (SELECT source_group, max(allowed_split) AS s FROM fingerprints WHERE coalesce(lower(trim(allowed_split)), '') NOT IN ('', 'unsure') GROUP BY 1)
SELECT v.canonical_id, v.source_group, coalesce(v.own, CASE WHEN n.n = 1 THEN g.s END, '') AS status FROM v JOIN n USING (source_group) LEFT JOIN g USING (source_group)
""")
def group_migration(spark: SparkSession, folder: str) -> DataFrame:
    v = table(spark, folder, "baseline_split_manifest").where("source_group is not null").select("canonical_id", "source_group", F.col("split_exclusion_reason").alias("status"))
    g = table(spark, folder, "fingerprints").select("source_group", F.col("allowed_split").alias("status"))
    return review.migrate_group_decisions(v, g, "source_group", "status").select("canonical_id", "source_group", "status")


@BOOK.query("""
SELECT m.canonical_id, m.license_reference, 'eligible_candidate' AS baseline_status FROM baseline_split_manifest m
WHERE m.canonical_id IN (SELECT canonical_id FROM baseline_split_manifest WHERE baseline_status = 'eligible_candidate')
""")
def accepted_view(spark: SparkSession, folder: str) -> DataFrame:
    m = table(spark, folder, "baseline_split_manifest")
    return review.accepted_view(m.select("canonical_id", "license_reference"), m, "canonical_id", "baseline_status", "eligible_candidate").select("canonical_id", "license_reference", "baseline_status")


@BOOK.query("""
WITH a AS (SELECT NegativeBatch, count(*) AS accepted FROM accepted_negatives_batch2_metadata WHERE ReviewStatus = 'accepted_negative' GROUP BY 1)
SELECT NegativeBatch, accepted, CASE WHEN accepted < 50 THEN 'not_sufficient' WHEN accepted <= 55 THEN 'satisfied' ELSE 'review_required' END AS verdict FROM a
""")
def pool_sufficiency(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "accepted_negatives_batch2_metadata").where("ReviewStatus = 'accepted_negative'").groupBy("NegativeBatch").agg(F.count(F.lit(1)).alias("accepted"))
    return a.withColumn("verdict", review.sufficiency(F.col("accepted"), 50, 55))
