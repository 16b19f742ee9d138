"""Text recognition metrics: exact match, edit distance, character error rate, slices, line choice, upscaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.text import ocr_plain

# Image height below which a crop is enlarged, and the height it gets.
SMALL, ENLARGED = 32, 96


def with_distance(df: DataFrame, truth: str, text: str) -> DataFrame:
    """Add ``normalized_text``, ``edit_distance`` and ``exact_match`` to the plain truth; null counts as empty text."""
    plain = F.coalesce(ocr_plain(F.col(text)), F.lit(""))
    want = F.coalesce(ocr_plain(F.col(truth)), F.lit(""))
    return df.withColumns({"normalized_text": plain, "edit_distance": F.levenshtein(plain, want), "exact_match": plain == want, "truth_length": F.length(want)})


def summary(scored: DataFrame, *by: str) -> DataFrame:
    """Rows, exact matches and accuracy, edit distance, characters, character error rate and accuracy, empty results."""
    safe = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    agg = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if("exact_match").alias("exact_count"), F.coalesce(F.sum("edit_distance"), F.lit(0)).alias("edit_distance"),
        F.coalesce(F.sum("truth_length"), F.lit(0)).alias("characters"), F.count_if(F.col("normalized_text") == "").alias("empty_count"),
    )
    cer = safe(F.col("edit_distance"), F.col("characters"))
    return agg.select(
        *by, "row_count", "exact_count", F.round(safe(F.col("exact_count"), F.col("row_count")), 4).alias("exact_rate"), "edit_distance", "characters",
        F.round(cer, 4).alias("cer"), F.round(1 - cer, 4).alias("char_accuracy"), "empty_count",
    )


def slice_accuracy(scored: DataFrame, notes: str, separator: str = ";") -> DataFrame:
    """Exact matches for each condition in the list of notes; a row counts for each of its conditions."""
    parts = F.explode(F.array_distinct(F.filter(F.transform(F.split(F.col(notes), separator), lambda x: F.trim(x)), lambda x: x != "")))
    rows = scored.withColumn("condition", parts)
    return rows.groupBy("condition").agg(F.count(F.lit(1)).alias("row_count"), F.count_if("exact_match").alias("exact_count"))


def line_score(line: Column, confidence: Column) -> Column:
    """How much a line looks like a plate: letters and digits both, five to nine characters, confidence, less for long texts."""
    plain = F.coalesce(ocr_plain(line), F.lit(""))
    n = F.length(plain)
    both = plain.rlike("[A-Z]") & plain.rlike("[0-9]")
    return F.when(both, 2.0).otherwise(0.0) + F.when((n >= 5) & (n <= 9), 2.0).otherwise(0.0) + F.coalesce(confidence, F.lit(0.0)) - F.greatest(n - 9, F.lit(0)) * 0.25


def choose_line(df: DataFrame, key: str, lines: str, confidence: str) -> DataFrame:
    """The best line of each key's raw text (lines split at line breaks; ties to the first): ``key, candidate, score``."""
    rows = df.select(key, confidence, F.posexplode(F.split(F.coalesce(lines, F.lit("")), r"\r?\n")).alias("at", "line"))
    rows = rows.withColumn("score", line_score(F.col("line"), F.col(confidence)))
    return rows.groupBy(key).agg(F.max_by("line", F.struct("score", -F.col("at"))).alias("candidate"), F.max("score").alias("score"))


def upscale(width: Column, height: Column) -> list[Column]:
    """``scale_factor, processed_width, processed_height``: crops lower than 32 pixels become 96 high."""
    scale = F.when(height < SMALL, F.lit(float(ENLARGED)) / height).otherwise(F.lit(1.0))
    grown = lambda x: F.bround(x * scale).cast("int")
    return [scale.alias("scale_factor"), grown(width).alias("processed_width"), grown(height).alias("processed_height")]
