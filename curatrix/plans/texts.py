"""Text, list and recognition queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.evaluate import ocr
from curatrix.functions import text as tx
from curatrix.plans.registry import Book
from curatrix.session import table

BOOK = Book()


@BOOK.query(r"""
SELECT canonical_id, regexp_replace(source_group, '(?i)\.rf\.[0-9a-f]{32}\.[a-z0-9]+$', '') AS source_key,
  CASE WHEN contains(source_group, '#t=') THEN split_part(source_group, '#t=', 1) ELSE regexp_replace(regexp_replace(source_group, '^.*[/\\]', ''), '(.)\.[^.]*$', '\1') END AS sequence
FROM baseline_split_manifest
""")
def source_keys(spark: SparkSession, folder: str) -> DataFrame:
    g = F.col("source_group")
    return table(spark, folder, "baseline_split_manifest").select("canonical_id", tx.strip_export_suffix(g).alias("source_key"), tx.sequence_name(g).alias("sequence"))


@BOOK.query(r"""
SELECT canonical_id, regexp_extract(source_image, '^(.+)#t=(\d+)\.[A-Za-z0-9]+$', 1) AS sequence, regexp_extract(source_image, '^(.+)#t=(\d+)\.[A-Za-z0-9]+$', 2)::INTEGER AS frame
FROM baseline_split_manifest WHERE regexp_matches(source_image, '^(.+)#t=(\d+)\.[A-Za-z0-9]+$')
""")
def sequence_frames(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "baseline_split_manifest").select("canonical_id", tx.sequence_frame(F.col("source_image"), strict=False).alias("s"))
    return rows.where("s is not null").select("canonical_id", "s.sequence", "s.frame")


@BOOK.query("""
SELECT ImageID, regexp_full_match(coalesce(ImageID, ''), '[0-9a-fA-F]{16}') AS is_id, lower(trim(ImageID, ' ')) AS folded, coalesce(nullif(trim(Title, ' '), ''), '<MISSING>') AS title FROM accepted_negatives_batch2_metadata
""")
def id_predicates(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("ImageID")
    return table(spark, folder, "accepted_negatives_batch2_metadata").select("ImageID", tx.is_hex_id(i).alias("is_id"), tx.folded(i).alias("folded"), tx.fill_blank(F.col("Title")).alias("title"))


@BOOK.query(r"""
SELECT canonical_id, source_dataset || '::' || source_group AS group_key, regexp_replace(regexp_replace(source_path, '^.*[/\\]', ''), '(.)\.[^.]*$', '\1') AS stem, lower(regexp_extract(source_path, '[^/\\](\.[^./\\]*)$', 1)) AS suffix,
  CASE WHEN starts_with(canonical_image_path, 'AI/') THEN 'data/' || substr(canonical_image_path, 4) ELSE canonical_image_path END AS moved, starts_with(source_path, 'raw/romanian/') AS in_root FROM baseline_split_manifest
""")
def path_parts(spark: SparkSession, folder: str) -> DataFrame:
    p = F.col("source_path")
    return table(spark, folder, "baseline_split_manifest").select(
        "canonical_id", tx.composite(F.col("source_dataset"), F.col("source_group")).alias("group_key"), tx.stem(p).alias("stem"), tx.suffix(p).alias("suffix"),
        tx.move_prefix(F.col("canonical_image_path"), "AI/", "data/").alias("moved"), tx.inside(p, F.lit("raw/romanian")).alias("in_root"),
    )


@BOOK.query("""
SELECT NegativeBatch, string_agg(DISTINCT CandidateCategory, ';' ORDER BY CandidateCategory) AS categories FROM accepted_negatives_batch2_metadata GROUP BY 1
""")
def sorted_distinct_concat(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "accepted_negatives_batch2_metadata").groupBy("NegativeBatch").agg(tx.sorted_concat(F.col("CandidateCategory")).alias("categories"))


@BOOK.query("""
SELECT trim(c, ' ') AS class_name, count(*) AS row_count FROM (SELECT unnest(string_split(MatchedClasses, ';')) AS c FROM accepted_negatives_batch2_metadata) WHERE trim(c, ' ') <> '' GROUP BY 1
""")
def explode_list(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "accepted_negatives_batch2_metadata").select(F.explode(tx.list_items(F.col("MatchedClasses"))).alias("class_name"))
    return rows.groupBy("class_name").agg(F.count(F.lit(1)).alias("row_count"))


@BOOK.query("""
SELECT canonical_id, CASE WHEN split_exclusion_reason <> '' THEN split_exclusion_reason WHEN plate_instance_count = 0 THEN 'empty' WHEN license_reference IS NULL THEN 'no_licence' ELSE 'accepted' END AS status,
  lower(trim(avax_split, ' ')) IN ('train', 'training') AS in_train FROM baseline_split_manifest
""")
def status_case(spark: SparkSession, folder: str) -> DataFrame:
    reason = F.col("split_exclusion_reason")
    status = F.when(reason != "", reason).otherwise(tx.first_status((F.col("plate_instance_count") == 0, "empty"), (F.col("license_reference").isNull(), "no_licence")))
    return table(spark, folder, "baseline_split_manifest").select("canonical_id", status.alias("status"), tx.folded(F.col("avax_split")).isin("train", "training").alias("in_train"))


@BOOK.query("""
WITH w AS (SELECT * FROM (VALUES ('true'), ('FALSE'), (' Yes '), ('no'), ('1'), ('0')) t(word)), p AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'FALSE' WHEN 2 THEN ' Yes ' WHEN 3 THEN 'no' WHEN 4 THEN '1' ELSE '0' END AS word FROM part)
SELECT lower(trim(word, ' ')) IN ('true', 'yes', '1') AS flag, count(*) AS row_count FROM p GROUP BY 1
""")
def text_to_bool(spark: SparkSession, folder: str) -> DataFrame:
    words = F.array(*map(F.lit, ["true", "FALSE", " Yes ", "no", "1", "0"]))
    word = F.element_at(words, (F.col("p_partkey") % 6 + 1).cast("int"))
    return table(spark, folder, "part").select(tx.to_bool(word).alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("row_count"))


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    """Names of parts and what a recognizer might have read: letters mistaken, dropped, or nothing."""
    k, name = F.col("p_partkey") % 5, F.concat("p_name", F.lit("-"), F.col("p_partkey").cast("string"))
    read = F.when(k == 0, name).when(k == 1, F.translate(name, "1e", "IE")).when(k == 2, F.substring(name, 2, 100)).when(k == 3, F.translate(F.lower(name), "rg0", "R6o")).otherwise("")
    return ocr.with_distance(table(spark, folder, "part").select("p_type", name.alias("truth"), read.alias("read")), "truth", "read")


_OCR = """WITH r AS (SELECT p_type, p_partkey % 5 AS k, p_name || '-' || p_partkey AS truth FROM part),
q AS (SELECT *, CASE k WHEN 0 THEN truth WHEN 1 THEN translate(truth, '1e', 'IE') WHEN 2 THEN substr(truth, 2) WHEN 3 THEN translate(lower(truth), 'rg0', 'R6o') ELSE '' END AS read FROM r),
t AS (SELECT *, upper(regexp_replace(read, '[^A-Za-z0-9]+', '', 'g')) AS n, upper(regexp_replace(truth, '[^A-Za-z0-9]+', '', 'g')) AS g FROM q),
s AS (SELECT *, levenshtein(n, g) AS d, n = g AS hit FROM t)
"""


@BOOK.query(_OCR + """SELECT p_type, count(*) AS row_count, count(*) FILTER (hit) AS exact_count, round(count(*) FILTER (hit) / count(*), 4) AS exact_rate, sum(d)::BIGINT AS edit_distance, sum(length(g))::BIGINT AS characters,
  round(sum(d) / sum(length(g)), 4) AS cer, round(1 - sum(d) / sum(length(g)), 4) AS char_accuracy, count(*) FILTER (n = '') AS empty_count FROM s GROUP BY 1""")
def edit_distance_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return ocr.summary(_readings(spark, folder), "p_type")


@BOOK.query("""WITH t AS (SELECT canonical_id, upper(regexp_replace(coalesce(source_group, ''), '[^A-Za-z0-9]+', '', 'g')) = upper(regexp_replace(coalesce(provenance_id, ''), '[^A-Za-z0-9]+', '', 'g')) AS hit,
  list_distinct(list_filter(list_transform(string_split(canonical_image_path, '/'), lambda x: trim(x, ' ')), lambda x: x <> '' AND NOT contains(x, '.'))) AS c FROM baseline_split_manifest), u AS (SELECT hit, unnest(c) AS condition FROM t)
SELECT condition, count(*) AS row_count, count(*) FILTER (hit) AS exact_count FROM u GROUP BY 1""")
def slice_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    rows = ocr.with_distance(table(spark, folder, "baseline_split_manifest"), "source_group", "provenance_id")
    notes = F.array_join(F.filter(F.split("canonical_image_path", "/"), lambda x: ~F.contains(x, F.lit("."))), "/")
    return ocr.slice_accuracy(rows.withColumn("notes", notes), "notes", "/")


@BOOK.query("""
SELECT canonical_id, CASE WHEN height < 32 THEN 96.0::DOUBLE / height ELSE 1 END AS scale_factor, round_even(width * CASE WHEN height < 32 THEN 96.0::DOUBLE / height ELSE 1 END, 0)::INTEGER AS processed_width,
  round_even(height * CASE WHEN height < 32 THEN 96.0::DOUBLE / height ELSE 1 END, 0)::INTEGER AS processed_height FROM (SELECT canonical_id, width // 16 AS width, height // 16 AS height FROM fingerprints)
""")
def selective_upscale(spark: SparkSession, folder: str) -> DataFrame:
    f = table(spark, folder, "fingerprints").select("canonical_id", F.expr("width div 16").cast("int").alias("width"), F.expr("height div 16").cast("int").alias("height"))
    return f.select("canonical_id", *ocr.upscale(F.col("width"), F.col("height")))


@BOOK.query(r"""
WITH l AS (SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '\r?\n')) AS line, generate_subscripts(regexp_split_to_array(coalesce(text, ''), '\r?\n'), 1) - 1 AS place FROM documents),
p AS (SELECT *, upper(regexp_replace(line, '[^A-Za-z0-9]+', '', 'g')) AS n FROM l),
s AS (SELECT *, CASE WHEN regexp_matches(n, '[A-Z]') AND regexp_matches(n, '[0-9]') THEN 2.0::DOUBLE ELSE 0 END + CASE WHEN length(n) BETWEEN 5 AND 9 THEN 2.0::DOUBLE ELSE 0 END + 0.5::DOUBLE - greatest(length(n) - 9, 0) * 0.25::DOUBLE AS score FROM p)
SELECT doc_id, max_by(line, (score, -place)) AS candidate, max(score) AS score FROM s GROUP BY 1
""")
def plate_line_choice(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", F.lit(0.5).alias("confidence"))
    return ocr.choose_line(docs, "doc_id", "text", "confidence")
