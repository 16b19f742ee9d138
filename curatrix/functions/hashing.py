"""Hashes, packed 64-bit fingerprints and Hamming distance as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hex64(text: Column) -> Column:
    """A string of 16 hex digits of either case as a signed 64-bit integer; null if it is anything else."""
    digits = F.lower(F.trim(text))
    return F.when(digits.rlike("^[0-9a-f]{16}$"), F.conv(digits, 16, -10).cast("bigint"))


def hamming(a: Column, b: Column) -> Column:
    """Number of differing bits of two 64-bit integers."""
    return F.bit_count(a.bitwiseXOR(b))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body uses it inside a fold or filter."""
    return F.element_at(F.transform(F.array(value), body), 1)


def pack_bits(values: Column, above: Column) -> Column:
    """64 numbers as a 64-bit integer, most significant bit first; a bit is set if its number is above ``above``."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return let(above, lambda m: F.aggregate(values, zero, lambda acc, x: F.shiftleft(acc, 1).bitwiseOR(F.when(x > m, one).otherwise(zero))))


def median_without_first(values: Column) -> Column:
    """Median of all numbers of an array but the first, the odd one out of a cosine transform."""
    return let(F.array_sort(F.slice(values, 2, F.size(values) - 1)), lambda rest: F.element_at(rest, ((F.size(rest) + 1) / 2).cast("int")))


def stable_id(prefix: Column, identity: Column) -> Column:
    """``prefix__`` and the first 16 hex digits of the SHA-256 of the identity."""
    return F.concat(prefix, F.lit("__"), F.substring(F.sha2(identity, 256), 1, 16))


def row_digest(*cols: str | Column) -> Column:
    """SHA-256 of the columns as a JSON object, null fields left out."""
    return F.sha2(F.to_json(F.struct(*cols)), 256)


def table_digest(*cols: str | Column) -> list[Column]:
    """Aggregate: ``row_count`` and ``digest``, the sum over the first 60 bits of the row digests; the order of rows makes no difference."""
    part = F.conv(F.substring(row_digest(*cols), 1, 15), 16, 10).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(part), F.lit(0)).cast("string").alias("digest")]


def file_sha256(content: Column, upper: bool = False) -> Column:
    """SHA-256 of a binary column in hex digits."""
    digest = F.sha2(content, 256)
    return F.upper(digest) if upper else digest
