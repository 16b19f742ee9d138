"""Split and sampling queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.operators import selection
from curatrix.plans.registry import Book
from curatrix.session import table

BOOK = Book()

_RANK = """SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY sha256(o_orderkey::VARCHAR || '|'), o_orderkey) AS r,
  round_even(count(*) OVER (PARTITION BY o_orderpriority) * 0.1::DOUBLE, 0) AS n FROM orders"""
_SPLIT = f"SELECT o_orderkey, o_orderpriority, CASE WHEN r <= n THEN 'val' WHEN r <= 2 * n THEN 'test' ELSE 'train' END AS split FROM ({_RANK})"


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("key"), "o_orderpriority", "o_orderstatus")


@BOOK.query(_SPLIT)
def leakage_safe_split(spark: SparkSession, folder: str) -> DataFrame:
    return selection.hash_split(_orders(spark, folder), "key", "o_orderpriority").select("o_orderkey", "o_orderpriority", "split")


@BOOK.query(f"SELECT o_orderpriority, split, count(*) AS row_count FROM ({_SPLIT}) GROUP BY 1, 2")
def split_composition(spark: SparkSession, folder: str) -> DataFrame:
    return leakage_safe_split(spark, folder).groupBy("o_orderpriority", "split").agg(F.count(F.lit(1)).alias("row_count"))


@BOOK.query(f"""
WITH s AS (SELECT o.o_orderkey, s.split, o.o_orderstatus = 'F' AS synthetic FROM ({_SPLIT}) s JOIN orders o USING (o_orderkey)),
t AS (SELECT *, row_number() OVER (PARTITION BY synthetic AND split = 'train' ORDER BY sha256(o_orderkey::VARCHAR || '|cap')) AS r,
  count(*) FILTER (NOT synthetic AND split = 'train') OVER () // 3 AS cap FROM s)
SELECT o_orderkey, CASE WHEN synthetic AND split = 'train' AND r > cap THEN 'baseline_synthetic_cap' END AS exclusion_reason FROM t
""")
def synthetic_cap(spark: SparkSession, folder: str) -> DataFrame:
    rows = selection.hash_split(_orders(spark, folder), "key", "o_orderpriority")
    capped = selection.synthetic_cap(rows, "key", F.col("o_orderstatus") == "F", F.col("split") == "train", 3, "cap")
    return capped.select("o_orderkey", "exclusion_reason")


@BOOK.query("""
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'train' WHEN c_nationkey % 3 = 0 THEN 'val' WHEN c_nationkey % 3 = 1 THEN 'test' ELSE 'train' END AS split FROM customer
""")
def mapped_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").withColumn("g", (F.col("c_nationkey") % 3).cast("string"))
    out = selection.mapped_split(rows, "g", {"0": "val", "1": "test", "2": "train"})
    return selection.pinned_split(out, F.col("c_mktsegment") == "BUILDING").select("c_custkey", "split")


@BOOK.query("SELECT doc_id, source FROM documents ORDER BY sha256(doc_id::VARCHAR || '|s1'), doc_id LIMIT 100")
def hash_topk_sample(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", F.col("doc_id").cast("string").alias("key"))
    return selection.hash_sample(docs, "key", 100, "s1").select("doc_id", "source")


_QUOTAS = {"heavy_equipment_candidate": 30, "vehicle_no_visible_plate_candidate": 25, "road_gate_scene": 20, "people": 10}


def _quota_sql() -> str:
    lines, taken = [], "SELECT NULL AS ImageID WHERE false"
    for i, (c, q) in enumerate(_QUOTAS.items()):
        lines.append(
            f"q{i} AS (SELECT '{c}' AS CandidateCategory, ImageID FROM (SELECT DISTINCT ImageID FROM accepted_negatives_batch2_metadata WHERE CandidateCategory = '{c}') "
            f"WHERE ImageID NOT IN ({taken}) ORDER BY sha256(ImageID || '|q|{c}'), ImageID LIMIT {q})"
        )
        taken = " UNION ALL ".join(f"SELECT ImageID FROM q{k}" for k in range(i + 1))
    return "WITH " + ", ".join(lines) + " " + " UNION ALL ".join(f"SELECT * FROM q{i}" for i in range(len(_QUOTAS)))


@BOOK.query(_quota_sql())
def quota_sample(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "accepted_negatives_batch2_metadata").where("ImageID is not null").select("ImageID", "CandidateCategory")
    return selection.quota_sample(rows, "ImageID", "CandidateCategory", _QUOTAS, "q").select("CandidateCategory", "ImageID")


@BOOK.query(f"""
SELECT c AS CandidateCategory, q AS quota, least(q, n) AS taken, greatest(q - n, 0) AS shortfall FROM (SELECT c, q, (SELECT count(*) FROM ({_quota_sql()}) s WHERE s.CandidateCategory = c) AS n
FROM (VALUES {", ".join(f"('{c}', {q})" for c, q in _QUOTAS.items())}) t(c, q))
""")
def quota_shortfall(spark: SparkSession, folder: str) -> DataFrame:
    return selection.quota_shortfall(quota_sample(spark, folder), "CandidateCategory", _QUOTAS)


# The classes that make an image a candidate of a category.
CATEGORY_CLASSES = {
    "vehicle_no_visible_plate_candidate": ["Car", "Truck", "Van", "Bus", "Motorcycle"],
    "heavy_equipment_candidate": ["Truck", "Tractor", "Forklift", "Crane"],
    "people": ["Person", "Man", "Woman", "Boy", "Girl"],
    "road_gate_scene": ["Traffic sign", "Traffic light", "Stop sign", "Parking meter"],
    "text_like_object": ["Billboard", "Poster", "Traffic sign"],
    "barrier_background": ["Fence", "Door", "Window", "Building"],
}


@BOOK.query(f"""
WITH l AS (SELECT ImageID, unnest(string_split(MatchedClasses, ';')) AS label FROM accepted_negatives_batch2_metadata WHERE ImageID IS NOT NULL),
c AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{x}')" for k, v in CATEGORY_CLASSES.items() for x in v)}) t(category, label))
SELECT category, ImageID, string_agg(DISTINCT label, ';' ORDER BY label) AS matched FROM l JOIN c USING (label) WHERE ImageID NOT IN (SELECT ImageID FROM l WHERE label = 'Tree')
  AND ImageID NOT IN (SELECT source_group FROM baseline_split_manifest WHERE source_group IS NOT NULL) GROUP BY 1, 2
""")
def candidate_index(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "accepted_negatives_batch2_metadata").where("ImageID is not null").select("ImageID", F.explode(F.split("MatchedClasses", ";")).alias("label"))
    classes = spark.createDataFrame([(k, x) for k, v in CATEGORY_CLASSES.items() for x in v], "category string, label string")
    known = table(spark, folder, "baseline_split_manifest").select(F.col("source_group").alias("ImageID"))
    return selection.candidate_index(labels, classes, "ImageID", "label", ["Tree"], known)
