"""Problem 1: a sample that is the same in every run and only grows as records are added.

An identifier is a number of the fixed domain 0 .. 2^64 - 1 (its own 16 hex digits) within
its dataset's prefix. The number is permuted by a Feistel network keyed by seed and
prefix, and the record is selected if the permuted number lies under ``rate * 2^64``. The decision depends on the identifier alone: no count, no
order and no other record matters, so it holds in any partitioning and for later rows.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.hashing import let
from curatrix.llm.names import group_key, id_key

HALF = 1 << 32
PRIME = 4294967291  # the largest prime below 2^32: products with 31-bit factors fit 64 bits
ROUNDS = 6


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Odd multipliers below 2^31 and an offset for each round, drawn from the seed."""
    out = []
    for i in range(rounds):
        raw = hashlib.sha256(f"feistel:{seed}:{i}".encode()).digest()
        a, b, c = (int.from_bytes(raw[k : k + 4], "big") for k in (0, 4, 8))
        out.append((a >> 1 | 1, b >> 1 | 1, c >> 1))
    return out


def _long(x: int) -> Column:
    return F.lit(x).cast("bigint")


def _halves(x: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(x, 32), x.bitwiseAND(_long(HALF - 1))


def feistel(number: Column, tweak: Column, seed: int, finish=None) -> Column:
    """The permuted number, a 64-bit integer whose sign bit is its top bit; ``finish`` may turn it into something else.

    Each round swaps the halves and adds a function of one to the other, so no two
    numbers of one tweak (below 2^28) meet. The rounds are a fold, which keeps the
    expression small.
    """

    keys = F.array(*(F.struct(_long(a).alias("a"), _long(b).alias("b"), _long(c).alias("c")) for a, b, c in round_keys(seed)))

    def body(start: Column) -> Column:
        def turn(x: Column, key: Column) -> Column:
            high, low = _halves(x)
            mixed = (low * key["a"] + key["c"] + start["tweak"]) % _long(PRIME)
            mixed = (mixed.bitwiseXOR(F.shiftright(mixed, 15)) * key["b"]) % _long(PRIME)
            return F.shiftleft(low, 32).bitwiseOR(high.bitwiseXOR(mixed))

        return F.aggregate(keys, start["number"], turn, finish) if finish else F.aggregate(keys, start["number"], turn)

    return let(F.struct(number.alias("number"), tweak.alias("tweak")), body)


def feistel_int(number: int, tweak: int, seed: int) -> int:
    """The same permutation of one number, for tests."""
    high, low = divmod(number, HALF)
    for a, b, c in round_keys(seed):
        mixed = (low * a + c + tweak) % PRIME
        mixed = (mixed ^ (mixed >> 15)) * b % PRIME
        high, low = low, high ^ mixed
    return high * HALF + low


OWN_NUMBER = "^([^_]+)__([0-9a-f]{16})$"


def numeric(key: Column) -> tuple[Column, Column]:
    """(number, tweak) of an identifier.

    A canonical id ``prefix__`` + 16 hex digits is that number under the tweak of its
    prefix, so distinct ids of a dataset never share one. Any other text (a group's
    name, a foreign id) has the first 64 bits of its SHA-256 under the tweak 0; two of
    them share a number, and with it their fate, with probability 2^-64 a pair.
    """
    own = key.rlike(OWN_NUMBER)
    digits = F.when(own, F.substring(key, -16, 16)).otherwise(F.substring(F.sha2(key, 256), 1, 16))
    prefix = F.substring(F.sha2(F.regexp_extract(key, OWN_NUMBER, 1), 256), 1, 7)
    tweak = F.when(own, F.conv(prefix, 16, 10).cast("bigint")).otherwise(_long(0))
    return F.conv(digits, 16, -10).cast("bigint"), tweak


def under_rate(key: Column, rate: float, seed: int) -> Column:
    """Whether the permuted number of ``key`` lies under ``rate`` of the domain; false for a null key."""
    limit = int(Fraction(str(rate)) * HALF * HALF)
    if not 0 <= limit <= HALF * HALF:
        raise ValueError("rate must lie between 0 and 1")
    top, rest = divmod(limit, HALF)

    def under(x: Column) -> Column:
        high, low = _halves(x)
        return (high < _long(top)) | ((high == _long(top)) & (low < _long(rest)))

    return F.coalesce(let(key, lambda k: feistel(*numeric(k), seed, under)), F.lit(False))


def stable_sample(df: DataFrame, rate: float, seed: int = 7, unit: str = "record") -> DataFrame:
    """The sampled records of a manifest, one row for each identifier.

    Needs ``canonical_id, source_dataset, source_group, manifest_version``; other
    columns are ignored whatever their names. With ``unit="group"`` all records of a
    source group are in or out together, and a record without a group stands for
    itself. Result: ``record_key`` (the id without case, blanks and image extension),
    ``unit_key`` (what was drawn), ``spellings`` (distinct spellings of the id),
    ``rows`` and ``first_version``. Selection comes before the aggregation, so only
    the sampled share is shuffled, pre-aggregated.

    A null or blank id is never selected. Repeated and respelt rows are one record.
    A record whose rows disagree about the group is selected if any of its groups
    is: later rows can add groups but not take one away, so nothing selected is lost.
    An empty table gives an empty result; rate 0 gives nothing, rate 1 every record.
    """
    if unit not in ("record", "group"):
        raise ValueError("unit is record or group")
    rows = df.select(
        id_key(F.col("canonical_id")).alias("record_key"),
        F.col("canonical_id").alias("id"),
        group_key(F.col("source_dataset"), F.col("source_group")).alias("group"),
        F.col("manifest_version").alias("version"),
    ).where("record_key is not null")
    drawn = F.col("record_key") if unit == "record" else F.coalesce("group", "record_key")
    return (
        rows.withColumn("unit_key", drawn)
        .where(under_rate(F.col("unit_key"), rate, seed))
        .groupBy("record_key")
        .agg(
            F.min("unit_key").alias("unit_key"),
            F.count_distinct("id").alias("spellings"),
            F.count(F.lit(1)).alias("rows"),
            F.min("version").alias("first_version"),
        )
    )


def growth_report(df: DataFrame, rate: float, seed: int = 7, versions: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """For each manifest version: records selected from the rows up to it, those selected before, and those lost.

    Takes what ``stable_sample`` takes and draws the sample anew for each version.
    Rows without a version count as delivered with the first.
    """
    rows = df.withColumn("manifest_version", F.coalesce("manifest_version", F.lit(min(versions))))
    drawn = None
    for v in versions:
        now = stable_sample(rows.where(F.col("manifest_version") <= v), rate, seed).select("record_key", F.lit(v).alias("version"))
        drawn = now if drawn is None else drawn.unionByName(now)
    flags = drawn.groupBy("record_key").agg(*(F.max(F.col("version") == v).alias(f"in_{v}") for v in versions))
    n = lambda when: F.count_if(F.coalesce(when, F.lit(False)))
    lines = []
    for before, v in zip((None, *versions), versions):
        old = F.col(f"in_{before}") if before is not None else F.lit(False)
        lines += [n(F.col(f"in_{v}")).alias(f"s{v}"), n(old & F.col(f"in_{v}")).alias(f"k{v}"), n(old & ~F.col(f"in_{v}")).alias(f"l{v}")]
    lines = flags.agg(*lines)
    cells = ", ".join(f"{v}, s{v}, k{v}, l{v}" for v in versions)
    return lines.select(F.expr(f"stack({len(versions)}, {cells}) as (manifest_version, selected_records, kept_records, lost_records)"))
