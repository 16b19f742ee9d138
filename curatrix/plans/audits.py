"""Audit queries: counts, distributions, completeness, pairing, leakage, policy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix import contracts
from curatrix.operators import audit
from curatrix.plans.duplicates import NEAR_SQL, near_pairs
from curatrix.plans.registry import Book
from curatrix.session import materialize, table

BOOK = Book()


@BOOK.query("""
SELECT count(*) AS row_count, count(*) FILTER (is_negative) AS negatives, count(*) FILTER (real_synthetic = 'SYNTHETIC') AS synthetic,
  coalesce(sum(plate_instance_count), 0)::BIGINT AS instances FROM baseline_split_manifest
""")
def pool_totals(spark: SparkSession, folder: str) -> DataFrame:
    m = table(spark, folder, "baseline_split_manifest")
    return audit.totals(m, {"negatives": F.col("is_negative"), "synthetic": F.col("real_synthetic") == "SYNTHETIC"}, {"instances": F.col("plate_instance_count")})


@BOOK.query("SELECT source_dataset, count(*) AS row_count FROM baseline_split_manifest WHERE source_dataset IS NOT NULL GROUP BY 1")
def value_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return audit.distribution(table(spark, folder, "baseline_split_manifest"), "source_dataset")


@BOOK.query("SELECT Author, count(*) AS row_count FROM accepted_negatives_batch2_metadata WHERE Author IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def top_authors(spark: SparkSession, folder: str) -> DataFrame:
    return audit.top_values(table(spark, folder, "accepted_negatives_batch2_metadata"), "Author", 15)


@BOOK.query("SELECT count(DISTINCT canonical_id) AS canonical_id_distinct, count(DISTINCT source_group) AS source_group_distinct FROM baseline_split_manifest")
def distinct_keys(spark: SparkSession, folder: str) -> DataFrame:
    return audit.distinct_counts(table(spark, folder, "baseline_split_manifest"), "canonical_id", "source_group")


@BOOK.query("""
SELECT source_group, count(DISTINCT avax_split) AS distinct_values, count(*)::BIGINT AS row_count FROM baseline_split_manifest
WHERE source_group IS NOT NULL AND avax_split IS NOT NULL GROUP BY 1 HAVING count(DISTINCT avax_split) > 1
""")
def groups_in_several_splits(spark: SparkSession, folder: str) -> DataFrame:
    return audit.spanning_keys(table(spark, folder, "baseline_split_manifest"), "source_group", "avax_split")


@BOOK.query("SELECT source_dataset, count(*) AS row_count, coalesce(sum(plate_instance_count), 0)::BIGINT AS plate_instance_count_sum FROM baseline_split_manifest GROUP BY 1")
def instances_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return audit.count_and_sum(table(spark, folder, "baseline_split_manifest"), "source_dataset", "plate_instance_count")


@BOOK.query("""
WITH s AS (SELECT source_group, count(*) AS occurrences FROM baseline_split_manifest WHERE source_group IS NOT NULL GROUP BY 1)
SELECT occurrences, count(*) AS keys FROM s GROUP BY 1
""")
def count_of_counts(spark: SparkSession, folder: str) -> DataFrame:
    return audit.count_of_counts(table(spark, folder, "baseline_split_manifest"), "source_group")


_FIELDS = ["License", "AuthorProfileURL", "Author", "Title", "OriginalURL", "OriginalMD5", "CandidateCategory"]


@BOOK.query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS field, count(*) FILTER ({c} IS NOT NULL AND trim({c}) <> '') AS present, count(*) FILTER ({c} IS NULL OR trim({c}) = '') AS missing FROM accepted_negatives_batch2_metadata"
        for c in _FIELDS
    )
)
def field_completeness(spark: SparkSession, folder: str) -> DataFrame:
    return audit.completeness(table(spark, folder, "accepted_negatives_batch2_metadata"), *_FIELDS)


@BOOK.query("""
SELECT source_group, count(*) AS row_count, count(DISTINCT coalesce(source_dataset, '~')) = 1 AS same_source_dataset, count(DISTINCT coalesce(license_reference, '~')) = 1 AS same_license_reference
FROM baseline_split_manifest WHERE source_group IS NOT NULL GROUP BY 1 HAVING count(*) >= 2
""")
def group_agreement(spark: SparkSession, folder: str) -> DataFrame:
    return audit.agreement(table(spark, folder, "baseline_split_manifest"), "source_group", "source_dataset", "license_reference")


@BOOK.query("SELECT avg(CASE WHEN real_synthetic = 'SYNTHETIC' THEN 1.0::DOUBLE ELSE 0 END) AS synthetic_share FROM baseline_split_manifest")
def synthetic_share(spark: SparkSession, folder: str) -> DataFrame:
    return audit.share_of(table(spark, folder, "baseline_split_manifest"), F.col("real_synthetic") == "SYNTHETIC", "synthetic_share")


@BOOK.query("""
SELECT least(source_dataset_a, source_dataset_b) AS first, greatest(source_dataset_a, source_dataset_b) AS second, count(*) AS row_count
FROM group_links WHERE source_dataset_a IS NOT NULL AND source_dataset_b IS NOT NULL GROUP BY 1, 2
""")
def source_pair_counts(spark: SparkSession, folder: str) -> DataFrame:
    return audit.pair_counts(table(spark, folder, "group_links"), "source_dataset_a", "source_dataset_b")


@BOOK.query("""
SELECT source_group, count(*) FILTER (avax_split = 'train') AS in_train, count(*) FILTER (avax_split = 'val') AS in_val, count(*) FILTER (avax_split = 'test') AS in_test
FROM baseline_split_manifest WHERE source_group IS NOT NULL GROUP BY 1
""")
def split_membership(spark: SparkSession, folder: str) -> DataFrame:
    return audit.membership_counts(table(spark, folder, "baseline_split_manifest"), "source_group", "avax_split", ["train", "val", "test"])


@BOOK.query("""
SELECT count(*) AS pairs, min(d) AS min_abs, max(d) AS max_abs, round(avg(d), 9) AS mean_abs
FROM (SELECT abs(aspect_ratio - width::DOUBLE / height) AS d FROM fingerprints WHERE height > 0) WHERE d IS NOT NULL
""")
def aspect_errors(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "fingerprints").where("height > 0").select("aspect_ratio", (F.col("width") / F.col("height")).alias("exact"))
    return audit.error_summary(rows, "aspect_ratio", "exact").withColumn("mean_abs", F.round("mean_abs", 9))


@BOOK.query("""
WITH m AS (SELECT DISTINCT canonical_id FROM baseline_split_manifest WHERE canonical_id IS NOT NULL), f AS (SELECT DISTINCT canonical_id FROM fingerprints WHERE canonical_id IS NOT NULL)
SELECT canonical_id, CASE WHEN f.canonical_id IS NULL THEN 'missing' WHEN m.canonical_id IS NULL THEN 'orphan' ELSE 'paired' END AS state FROM m FULL OUTER JOIN f USING (canonical_id)
""")
def pairing_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.pairing(table(spark, folder, "baseline_split_manifest"), table(spark, folder, "fingerprints"), "canonical_id")


@BOOK.query("""
SELECT CASE WHEN l.k IS NULL THEN 'missing' WHEN o.k IS NULL THEN 'orphan' ELSE 'paired' END AS state, count(*) AS keys
FROM (SELECT DISTINCT o_orderkey AS k FROM orders) o FULL OUTER JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l USING (k) GROUP BY 1
""")
def image_box_pairing(spark: SparkSession, folder: str) -> DataFrame:
    o, li = table(spark, folder, "orders").select(F.col("o_orderkey").alias("k")), table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("k"))
    return audit.pairing(o, li, "k").groupBy("state").agg(F.count(F.lit(1)).alias("keys"))


@BOOK.query("""
WITH k AS (SELECT DISTINCT source_group AS g, lower(trim(avax_split)) AS s FROM baseline_split_manifest WHERE source_group IS NOT NULL AND avax_split IS NOT NULL)
SELECT a.s AS split_a, b.s AS split_b, count(*) AS shared_keys FROM k a JOIN k b USING (g) WHERE a.s < b.s GROUP BY 1, 2
""")
def split_overlap(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "baseline_split_manifest").select("source_group", F.lower(F.trim("avax_split")).alias("split"))
    return audit.split_overlap(rows, "source_group", "split")


@BOOK.query("SELECT count(*) AS images, count(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS negatives FROM orders")
def negative_count(spark: SparkSession, folder: str) -> DataFrame:
    o, li = table(spark, folder, "orders").select(F.col("o_orderkey").alias("k")), table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("k"))
    return audit.absent_count(o, li, "k")


@BOOK.query("""
WITH r AS (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS position, count(*) OVER () AS n FROM part)
SELECT p_partkey, position FROM r WHERE position IN (SELECT floor(i * (n - 1) / 11)::BIGINT FROM range(12) t(i))
""")
def evenly_spaced_parts(spark: SparkSession, folder: str) -> DataFrame:
    return audit.evenly_spaced(table(spark, folder, "part").select("p_partkey"), "p_partkey", 12).select("p_partkey", "position")


@BOOK.query("""
WITH m AS (SELECT canonical_id, min(lower(trim(avax_split))) AS split, min(source_group) AS source_group, min(real_synthetic) AS rs, min(allowed_split) AS al
  FROM baseline_split_manifest WHERE lower(trim(avax_split)) IN ('train', 'val', 'test') AND canonical_id IS NOT NULL GROUP BY canonical_id),
p AS (SELECT canonical_id, min(lower(pixel_sha256)) AS px FROM fingerprints GROUP BY 1), j AS (SELECT m.*, p.px FROM m LEFT JOIN p USING (canonical_id))
SELECT 'synthetic_in_eval' AS rule, count(*) FILTER (split <> 'train' AND rs <> 'REAL') AS violations FROM j
UNION ALL SELECT 'train_only_in_eval', count(*) FILTER (split <> 'train' AND al = 'TRAIN_ONLY') FROM j
UNION ALL SELECT 'synthetic_share', CASE WHEN count(*) FILTER (split = 'train' AND rs = 'SYNTHETIC') > 0.25 * count(*) FILTER (split = 'train') THEN 1 ELSE 0 END FROM j
UNION ALL SELECT 'group_in_several', count(*) FROM (SELECT source_group FROM j WHERE source_group IS NOT NULL GROUP BY 1 HAVING count(DISTINCT split) > 1)
UNION ALL SELECT 'pixels_in_several', count(*) FROM (SELECT px FROM j WHERE px IS NOT NULL GROUP BY 1 HAVING count(DISTINCT split) > 1)
UNION ALL SELECT 'unresolved_near_pairs', count(*) FROM ({near}) n JOIN j a ON a.canonical_id = n.canonical_id_a JOIN j b ON b.canonical_id = n.canonical_id_b WHERE a.split <> b.split AND n.phash_distance % 3 <> 0
""".replace("{near}", NEAR_SQL))
def split_policy_violations(spark: SparkSession, folder: str) -> DataFrame:
    m = table(spark, folder, "baseline_split_manifest").withColumn("split", F.lower(F.trim("avax_split"))).where("split in ('train', 'val', 'test') and canonical_id is not null")
    m = m.groupBy("canonical_id").agg(F.min("split").alias("split"), *(F.min(c).alias(c) for c in ("source_group", "real_synthetic", "allowed_split")))
    p = table(spark, folder, "fingerprints").groupBy("canonical_id").agg(F.min(F.lower("pixel_sha256")).alias("pixel_sha256"))
    status = F.when(F.col("phash_distance") % 3 == 0, "resolved").when(F.col("phash_distance") % 3 == 1, " Unsure ")
    pairs = near_pairs(spark, folder).select("canonical_id_a", "canonical_id_b", status.alias("status"))
    return contracts.policy_violations(materialize(m.join(p, "canonical_id", "left"), "policy"), near_pairs=pairs)


@BOOK.query("""
WITH m AS (SELECT canonical_id AS k, min(width::VARCHAR) AS d FROM fingerprints GROUP BY 1), f AS (SELECT canonical_id AS k, min(plate_instance_count::VARCHAR) AS d FROM baseline_split_manifest GROUP BY 1)
SELECT k, CASE WHEN f.k IS NULL THEN 'missing' WHEN m.k IS NULL THEN 'unexpected' ELSE 'changed' END AS problem FROM (SELECT k, d, true AS a FROM m) m FULL OUTER JOIN (SELECT k, d, true AS b FROM f) f USING (k)
WHERE m.a IS NULL OR f.b IS NULL OR m.d IS DISTINCT FROM f.d
""".replace("f.k IS NULL THEN", "f.b IS NULL THEN").replace("m.k IS NULL THEN", "m.a IS NULL THEN"))
def identity_differences(spark: SparkSession, folder: str) -> DataFrame:
    m = table(spark, folder, "fingerprints").groupBy(F.col("canonical_id").alias("k")).agg(F.min(F.col("width").cast("string")).alias("d"))
    f = table(spark, folder, "baseline_split_manifest").groupBy(F.col("canonical_id").alias("k")).agg(F.min(F.col("plate_instance_count").cast("string")).alias("d"))
    return contracts.identity_differences(m, f, "k", "d")
