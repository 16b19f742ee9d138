"""Exact and near duplicates, content ids and fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.functions.geometry import aspect_difference
from curatrix.functions.hashing import hex64, median_without_first, pack_bits, row_digest, stable_id
from curatrix.operators import dedup, review
from curatrix.operators.near import near_within
from curatrix.plans.registry import Book
from curatrix.session import materialize, table

BOOK = Book()


@BOOK.query("""
WITH m AS (SELECT doc_id, source, sha256(text) AS h FROM documents WHERE text IS NOT NULL),
g AS (SELECT h, count(*) AS members, count(DISTINCT source) AS sources FROM m GROUP BY h HAVING count(*) >= 2)
SELECT 'exact__' || substr(g.h, 1, 16) AS group_id, m.doc_id, m.source, g.members::BIGINT AS members, g.sources > 1 AS crosses_groups FROM m JOIN g USING (h)
""")
def exact_duplicate_groups(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").where("text is not null").select("doc_id", "source", F.sha2("text", 256).alias("h"))
    return dedup.exact_groups(docs, "h", "source").select("group_id", "doc_id", "source", "members", "crosses_groups")


@BOOK.query("""
WITH f AS (SELECT DISTINCT canonical_id, lower(pixel_sha256) AS h, leakage_source_group AS g FROM fingerprints WHERE pixel_sha256 IS NOT NULL)
SELECT 'exact__' || substr(h, 1, 16) AS group_id, count(*) AS members, count(DISTINCT g) > 1 AS crosses_groups FROM f GROUP BY h HAVING count(*) >= 2
""")
def pixel_duplicate_groups(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "fingerprints").select("canonical_id", F.lower("pixel_sha256").alias("h"), "leakage_source_group").distinct()
    return dedup.exact_groups(rows, "h", "leakage_source_group").select("group_id", "members", "crosses_groups").distinct()


@BOOK.query("""
WITH f AS (SELECT DISTINCT lower(pixel_sha256) AS h, lower(trim(source_dataset)) AS d FROM fingerprints WHERE pixel_sha256 IS NOT NULL)
SELECT h AS digest, count(DISTINCT d) AS sources, string_agg(DISTINCT d, ';' ORDER BY d) AS source_list FROM f GROUP BY h HAVING count(DISTINCT d) > 1
""")
def cross_source_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "fingerprints").select(F.lower("pixel_sha256").alias("digest"), F.lower(F.trim("source_dataset")).alias("d")).where("digest is not null").distinct()
    per = rows.groupBy("digest").agg(F.count("d").alias("sources"), F.array_join(F.array_sort(F.collect_set("d")), ";").alias("source_list"))
    return per.where("sources > 1")


@BOOK.query("""
SELECT canonical_id, 'openimages__' || substr(sha256(source_dataset || '|' || source_path), 1, 16) AS content_id FROM baseline_split_manifest
""")
def content_id_assignment(spark: SparkSession, folder: str) -> DataFrame:
    identity = F.concat("source_dataset", F.lit("|"), "source_path")
    return table(spark, folder, "baseline_split_manifest").select("canonical_id", stable_id(F.lit("openimages"), identity).alias("content_id"))


@BOOK.query("""
WITH e AS (SELECT vec_id, embedding AS v, list_sort(embedding[2:64])[32] AS m FROM embeddings)
SELECT vec_id, list_reduce(list_prepend(0::HUGEINT, list_transform(v, lambda x: CASE WHEN x > m THEN 1::HUGEINT ELSE 0::HUGEINT END)), lambda a, b: a * 2 + b)::UBIGINT::VARCHAR AS phash FROM e
""")
def phash_pack(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack_bits(F.col("embedding"), median_without_first(F.col("embedding")))
    unsigned = F.conv(F.hex(packed), 16, 10)
    return table(spark, folder, "embeddings").select("vec_id", unsigned.alias("phash"))


NEAR_SQL = """
WITH f AS (SELECT DISTINCT canonical_id AS id, lower(pixel_sha256) AS px, ('0x' || lower(phash))::UBIGINT AS p, ('0x' || lower(dhash))::UBIGINT AS d,
  leakage_source_group AS g, allowed_split AS s, CASE WHEN width > 0 AND height > 0 THEN width::DOUBLE / height END AS a
  FROM fingerprints WHERE phash IS NOT NULL AND dhash IS NOT NULL)
SELECT DISTINCT x.id AS canonical_id_a, y.id AS canonical_id_b, bit_count(xor(x.p, y.p))::INTEGER AS phash_distance, bit_count(xor(x.d, y.d))::INTEGER AS dhash_distance
FROM f x JOIN f y ON x.id < y.id AND bit_count(xor(x.p, y.p)) <= 8 AND bit_count(xor(x.d, y.d)) <= 10 AND abs(x.a - y.a) / greatest(x.a, y.a) <= 0.15
  AND x.g IS DISTINCT FROM y.g AND NOT (x.s = 'TRAIN_ONLY' AND y.s = 'TRAIN_ONLY') AND x.px IS DISTINCT FROM y.px
"""


@BOOK.query(NEAR_SQL)
def near_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates of other groups: Hamming radius 8 and 10, aspect within 0.15, not both TRAIN_ONLY, not the same pixels."""
    rows = table(spark, folder, "fingerprints").select(
        F.col("canonical_id").alias("id"), F.lower("pixel_sha256").alias("px"), hex64(F.col("phash")).alias("phash"), hex64(F.col("dhash")).alias("dhash"),
        F.col("leakage_source_group").alias("g"), F.col("allowed_split").alias("s"), F.when((F.col("width") > 0) & (F.col("height") > 0), F.col("width") / F.col("height")).alias("a"),
    ).where("phash is not null and dhash is not null")
    equal = rows.groupBy("phash", "dhash").count().where("count > 1").select(*(F.col(c).alias(f"{c}_{k}") for k in "lr" for c in ("phash", "dhash")))
    pairs = materialize(near_within(rows, "phash", 8, "dhash", 10).unionByName(equal), "pairs")
    met = materialize(pairs.select("phash_l", "dhash_l").union(pairs.select("phash_r", "dhash_r")).toDF("phash", "dhash").distinct(), "met")
    few = met.count() <= 500_000  # two numbers each
    rows = materialize(rows.join(F.broadcast(met) if few else met, ["phash", "dhash"], "left_semi").distinct(), "prints")
    x, y = (rows.toDF(*(f"{c}_{k}" for c in rows.columns)) for k in "lr")
    both = pairs.join(x, ["phash_l", "dhash_l"]).join(y, ["phash_r", "dhash_r"]).where("id_l <> id_r")
    good = (aspect_difference(F.col("a_l"), F.col("a_r")) <= 0.15) & ~F.col("g_l").eqNullSafe(F.col("g_r")) & ~F.col("px_l").eqNullSafe(F.col("px_r"))
    only = F.coalesce((F.col("s_l") == "TRAIN_ONLY") & (F.col("s_r") == "TRAIN_ONLY"), F.lit(False))
    bits = lambda c: F.bit_count(F.col(f"{c}_l").bitwiseXOR(F.col(f"{c}_r"))).cast("int")
    return both.where(good & ~only).select(
        F.least("id_l", "id_r").alias("canonical_id_a"), F.greatest("id_l", "id_r").alias("canonical_id_b"), bits("phash").alias("phash_distance"), bits("dhash").alias("dhash_distance")
    ).distinct()


@BOOK.query("""
WITH m AS (SELECT DISTINCT canonical_id, source_group, plate_instance_count FROM baseline_split_manifest),
f AS (SELECT DISTINCT canonical_id, lower(pixel_sha256) AS h FROM fingerprints WHERE pixel_sha256 IS NOT NULL), j AS (SELECT * FROM f JOIN m USING (canonical_id)),
g AS (SELECT h, count(*) AS members, count(DISTINCT coalesce(source_group, '~')) = 1 AS same_sequence, count(DISTINCT coalesce(plate_instance_count, -1)) = 1 AS same_boxes FROM j GROUP BY h HAVING count(*) >= 2)
SELECT h AS digest, members, CASE WHEN same_sequence AND same_boxes THEN 'repeated_frame' WHEN same_sequence THEN 'repeated_frame_boxes_differ' ELSE 'across_sequences' END AS verdict FROM g
""")
def duplicate_assessment(spark: SparkSession, folder: str) -> DataFrame:
    m = table(spark, folder, "baseline_split_manifest").select("canonical_id", "source_group", "plate_instance_count").distinct()
    f = table(spark, folder, "fingerprints").select("canonical_id", F.lower("pixel_sha256").alias("digest")).where("digest is not null").distinct()
    return review.assess_duplicates(f.join(m, "canonical_id"), "digest", "source_group", "plate_instance_count").select("digest", "members", "verdict")


@BOOK.query("""
SELECT source_group, count(*) AS variants, count(DISTINCT lower(pixel_sha256)) AS pixel_versions, count(DISTINCT width) AS box_versions,
  count(DISTINCT lower(pixel_sha256)) = 1 AS identical_pixels, count(DISTINCT width) > 1 AS boxes_disagree
FROM fingerprints WHERE source_group IS NOT NULL GROUP BY source_group HAVING count(*) >= 2
""")
def source_variants(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "fingerprints").select("source_group", F.lower("pixel_sha256").alias("h"), "width")
    return review.variant_analysis(rows, "source_group", "h", "width")


@BOOK.query("""
SELECT doc_id, sha256('{"doc_id":' || doc_id || ',"n_chars":' || n_chars || '}') AS digest FROM documents WHERE n_chars IS NOT NULL
""")
def row_digests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").where("n_chars is not null").select("doc_id", row_digest("doc_id", "n_chars").alias("digest"))


@BOOK.query("""
WITH m AS (SELECT canonical_id, recorded_at, ingested_at, manifest_version FROM baseline_split_manifest WHERE canonical_id IS NOT NULL),
f AS (SELECT canonical_id, count(*) AS n, min(recorded_at) AS r FROM m GROUP BY 1)
SELECT (n > 1) AS repeated, count(*) AS row_count, count(DISTINCT canonical_id) AS ids FROM m JOIN f USING (canonical_id) GROUP BY 1
""")
def repeated_rows(spark: SparkSession, folder: str) -> DataFrame:
    m = table(spark, folder, "baseline_split_manifest").select("canonical_id", "recorded_at", "ingested_at").where("canonical_id is not null")
    flagged = review.flag_repeats(m, "canonical_id", ["recorded_at", "ingested_at"])
    return flagged.groupBy("repeated").agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("canonical_id").alias("ids"))
