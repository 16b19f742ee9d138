"""Problem 4: records of evaluation splits that also stand, exactly or almost, in train.

Every record is canonicalised (case, blanks, image extension of the id; case of the hex
digits), the canonical forms are hashed, and the hashes of the evaluation side are joined
with those of train. Almost equal pictures have other hashes; they are found by the
banded Hamming join of the perceptual fingerprints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.functions.hashing import hex64
from curatrix.llm.names import id_key, is_included, split_key, word_key
from curatrix.operators.near import hamming_join
from curatrix.session import materialize

PHASH_BITS, DHASH_BITS, ASPECT = 8, 10, 0.15


def _sides(manifest: DataFrame, fingerprints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct records (id, train) of known splits, and their distinct fingerprints."""
    rows = manifest.where(is_included(F.col("split_status"))).select(F.col("canonical_id").alias("id"), split_key(F.col("avax_split")).alias("split"))
    records = rows.where("id is not null and split is not null").select("id", (F.col("split") == "train").alias("train")).distinct()
    prints = fingerprints.where("canonical_id is not null").select(
        F.col("canonical_id").alias("id"),
        hex64(F.col("phash")).alias("phash"),
        hex64(F.col("dhash")).alias("dhash"),
        F.nullif(F.lower(F.trim(F.col("pixel_sha256"))), F.lit("")).alias("pixels"),
        F.when((F.col("width") > 0) & (F.col("height") > 0), F.col("width") / F.col("height")).alias("aspect"),
    )
    return records, records.join(prints.distinct(), "id")


def _two_hashes(kind: str, key) -> list:
    """128 bits of a canonical form, so that different forms never share both in practice."""
    return [F.xxhash64(F.lit(f"{kind}1"), key).alias("h1"), F.xxhash64(F.lit(f"{kind}2"), key).alias("h2")]


def overlap_pairs(manifest: DataFrame, fingerprints: DataFrame, phash_bits: int = PHASH_BITS, dhash_bits: int = DHASH_BITS, aspect: float = ASPECT, crowded: int = 4_000_000) -> DataFrame:
    """Columns ``eval_id, train_id, kind`` with kind ``id``, ``pixels`` or ``near``; a pair may have several kinds.

    Pairs of distinct ids as they stand, of included rows, one in train and the other
    in val or test: ids that differ only in case and an image extension, equal
    ``pixel_sha256``, or fingerprints within ``phash_bits`` and ``dhash_bits`` whose
    aspect ratios differ by at most ``aspect`` of the larger. A null or malformed value
    fulfils nothing; repeated rows count once; empty tables give an empty result; other
    columns than those named here are ignored.

    Equal fingerprints are joined as one class and expanded to ids at the end, so a
    frequent value costs its members and not their comparisons.
    """
    records, prints = _sides(manifest, fingerprints)
    prints = materialize(prints, "prints")
    keyed = records.select("id", "train", *_two_hashes("i", id_key(F.col("id"))), F.lit("id").alias("kind")).unionByName(
        prints.where("pixels is not null").select("id", "train", *_two_hashes("p", F.col("pixels")), F.lit("pixels").alias("kind"))
    )
    on = ["h1", "h2", "kind"]
    equal = keyed.where("not train").withColumnRenamed("id", "eval_id").drop("train").join(keyed.where("train").withColumnRenamed("id", "train_id").drop("train"), on)
    equal = equal.select("eval_id", "train_id", "kind")
    hashed = prints.where("phash is not null and dhash is not null and aspect is not null").select("id", "train", "phash", "dhash", "aspect")
    ev, tr = (hashed.where(w).drop("train") for w in ("not train", "train"))
    pairs = hamming_join(ev, tr, "phash", phash_bits, "dhash", dhash_bits, crowded)
    near = (
        pairs.join(ev.toDF("eval_id", "phash_l", "dhash_l", "aspect_l"), ["phash_l", "dhash_l"])
        .join(tr.toDF("train_id", "phash_r", "dhash_r", "aspect_r"), ["phash_r", "dhash_r"])
        .where(F.abs(F.col("aspect_l") - F.col("aspect_r")) / F.greatest("aspect_l", "aspect_r") <= aspect)
        .select("eval_id", "train_id", F.lit("near").alias("kind"))
    )
    return equal.unionByName(near).where("eval_id <> train_id").distinct()


def overlap_found(pairs: DataFrame) -> DataFrame:
    """Columns ``canonical_id_a, canonical_id_b`` (bytewise smaller first), each pair once."""
    return pairs.select(F.least("eval_id", "train_id").alias("canonical_id_a"), F.greatest("eval_id", "train_id").alias("canonical_id_b")).distinct()


def overlap_report(pairs: DataFrame, manifest: DataFrame) -> DataFrame:
    """``avax_split, source_dataset, train_source, kind, pairs, eval_records``: overlaps by the evaluation record's split and source and the train record's source.

    Split and source are in their normal spelling; a source without letters or digits is
    ``(missing)``. A record whose rows name several splits or sources counts in each.
    """
    rows = manifest.where(is_included(F.col("split_status"))).select(
        F.col("canonical_id").alias("id"),
        split_key(F.col("avax_split")).alias("avax_split"),
        F.coalesce(word_key(F.col("source_dataset")), F.lit("(missing)")).alias("source_dataset"),
    )
    hit = pairs.select(F.explode(F.array("eval_id", "train_id")).alias("id")).distinct()  # few records overlap
    rows = materialize(rows.where("avax_split is not null").distinct().join(hit, "id", "left_semi"), "overlapping")
    ev = rows.where("avax_split <> 'train'").withColumnRenamed("id", "eval_id")
    tr = rows.where("avax_split = 'train'").select(F.col("id").alias("train_id"), F.col("source_dataset").alias("train_source")).distinct()
    per = pairs.join(tr, "train_id").groupBy("eval_id", "train_source", "kind").agg(F.count(F.lit(1)).alias("n"))
    return per.join(ev, "eval_id").groupBy("avax_split", "source_dataset", "train_source", "kind").agg(F.sum("n").alias("pairs"), F.count_distinct("eval_id").alias("eval_records"))
