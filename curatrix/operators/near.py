"""Similarity join of 64-bit fingerprints by Hamming distance, exact by the pigeonhole principle."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.functions.hashing import hamming
from curatrix.session import materialize


def band_masks(bands: int) -> list[int]:
    """64 bits cut into ``bands`` runs of almost equal length, as unsigned masks."""
    edges = [round(i * 64 / bands) for i in range(bands + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def flips(mask: int, radius: int) -> list[int]:
    """All ways to change at most ``radius`` bits of ``mask``."""
    bits = [1 << i for i in range(64) if mask >> i & 1]
    return [sum(c) for r in range(radius + 1) for c in combinations(bits, r)]


def best_bands(distance: int, rows: int, row_cost: float = 30.0) -> int:
    """Number of bands with the least work: probes a row, each worth ``row_cost`` comparisons, and rows a bucket."""

    def work(bands: int) -> float:
        width, radius = 64 / bands, distance // bands
        probes = sum(comb(round(width), r) for r in range(radius + 1))
        return bands * probes * (row_cost + rows / 2**width)

    return min(range(2, min(distance + 2, 17)), key=work)


def _long(x: int):
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("bigint")


def _keys(bands: int, radius: int):
    """Literal array of (band, flip, mask)."""
    return F.array(*(F.struct(F.lit(i).alias("band"), _long(f).alias("flip"), _long(m).alias("mask")) for i, m in enumerate(band_masks(bands)) for f in flips(m, radius)))


def _spread(df: DataFrame, value: str, bands: int, radius: int, band: str, key: str) -> DataFrame:
    """One row for each band of ``value`` and each change of at most ``radius`` bits in it."""
    cols = df.columns
    return df.select(*cols, F.explode(_keys(bands, radius)).alias("__k")).select(
        *cols,
        F.col("__k.band").alias(band),
        F.col(value).bitwiseXOR(F.col("__k.flip")).bitwiseAND(F.col("__k.mask")).alias(key),
    )


def _first_band(a, b, band, bands: int, radius: int):
    """True in the first band in which a pair differs in at most ``radius`` bits, so a pair comes out once."""
    x = a.bitwiseXOR(b)
    at = F.lit(bands)
    for i, m in reversed(list(enumerate(band_masks(bands)))):
        at = F.when(F.bit_count(x.bitwiseAND(_long(m))) <= radius, F.lit(i)).otherwise(at)
    return band == at


def _loads(a: DataFrame, index: DataFrame, bands: int, radius: int) -> DataFrame:
    """``band, key, work``: probes times index rows of each bucket that has both.

    Rows are counted by their own key first, and only the counts take the bit changes.
    """
    own = _spread(a, "a1", bands, 0, "band", "key").groupBy("band", "key").agg(F.count(F.lit(1)).alias("m"))
    changed = F.explode(_keys(bands, radius)).alias("k")
    probes = own.select("band", "key", "m", changed).where("band = k.band").select("band", F.col("key").bitwiseXOR(F.col("k.flip")).alias("key"), "m")
    probes = probes.groupBy("band", "key").agg(F.sum("m").alias("m"))
    return index.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).join(probes, ["band", "key"]).select("band", "key", (F.col("n") * F.col("m")).alias("work"))


def _salted(probe: DataFrame, index: DataFrame, on: list[str], work: DataFrame, crowded: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``salt``: the index rows of a bucket with too much work in several parts, its probes copied to each part."""
    salts = F.least(F.ceil(F.col("work") / crowded), F.lit(10_000)).cast("int")
    parts = materialize(work.where(F.col("work") > crowded).select(*on, salts.alias("parts")), "salts")
    if parts.isEmpty():
        return (df.withColumn("salt", F.lit(0)) for df in (probe, index))
    probe, index = (df.join(parts, on, "left").withColumn("parts", F.coalesce("parts", F.lit(1))) for df in (probe, index))
    probe = probe.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return probe, index.withColumn("salt", F.pmod(F.xxhash64("b1", "b2") if "b2" in index.columns else F.xxhash64("b1"), F.col("parts")).cast("int")).drop("parts")


def hamming_join(
    left: DataFrame,
    right: DataFrame,
    first: str,
    first_bits: int,
    second: str | None = None,
    second_bits: int = 0,
    crowded: int = 4_000_000,
    bands: int | None = None,
    halve: bool = False,
) -> DataFrame:
    """Pairs of distinct fingerprints within the given distances.

    ``left`` and ``right`` have a bigint column ``first`` and, if named, ``second``;
    other columns are ignored, rows with a null in either are left out, repeated
    rows count once. The result has ``first_l, second_l, first_r, second_r`` (without
    the second pair where none is named), one row for each pair of distinct rows with
    at most ``first_bits`` differing bits in the first and ``second_bits`` in the second.
    ``halve`` keeps only pairs whose left row is not the larger, for a table with itself.

    Some band of the first value differs in at most ``first_bits // bands`` bits, so
    probing ``left`` with every such change finds every pair (an equi-join, no cross
    join). The number of bands follows the size of ``right``. The comparisons of every
    bucket are counted (probes times index rows). Buckets with more than ``crowded`` are
    cut again by bands of the second value in the same way, so one value that many rows
    share doesn't meet all of them; what is still too much is salted over several tasks.
    The counted work, not the bytes, sets the number of partitions. Equal fingerprints
    are one row on each side; expanding to members is left to the caller.
    """
    cols = [first] + ([second] if second else [])
    sides = [df.select(*cols).where(" and ".join(f"`{c}` is not null" for c in cols)).distinct() for df in (left, right)]
    spread = left.sparkSession.sparkContext.defaultParallelism  # few bytes, but each row probes many buckets
    sides = [df.repartition(spread) for df in sides]
    a = materialize(sides[0].toDF(*("a1", "a2")[: len(cols)]), "near")
    b = a.toDF(*("b1", "b2")[: len(cols)]) if left is right else materialize(sides[1].toDF(*("b1", "b2")[: len(cols)]), "near")
    bands = bands or best_bands(first_bits, b.count())
    radius = first_bits // bands
    probe, index = _spread(a, "a1", bands, radius, "band", "key"), _spread(b, "b1", bands, 0, "band", "key")
    good = hamming(F.col("a1"), F.col("b1")) <= first_bits
    if second:
        good &= hamming(F.col("a2"), F.col("b2")) <= second_bits
    if halve:
        good &= (F.col("a1") < F.col("b1")) | ((F.col("a1") == F.col("b1")) & (F.col("a2") <= F.col("b2") if second else F.lit(True)))
    good &= _first_band(F.col("a1"), F.col("b1"), F.col("band"), bands, radius)
    on, work = ["band", "key"], materialize(_loads(a, index, bands, radius), "loads")
    total = work.agg(F.sum(F.least("work", F.lit(crowded)))).first()[0] or 0
    if second:
        hot = work.where(F.col("work") > crowded).select(*on)
        if not hot.isEmpty():
            cut = best_bands(second_bits, 20_000)
            deep = second_bits // cut

            def deeper(df: DataFrame, value: str, reach: int) -> tuple[DataFrame, DataFrame]:
                marked = df.join(hot.withColumn("__hot", F.lit(True)), on, "left")
                plain = marked.where("__hot is null").drop("__hot").withColumns({"sub": F.lit(-1), "subkey": F.lit(0).cast("bigint")})
                return plain, _spread(marked.where("__hot").drop("__hot"), value, cut, reach, "sub", "subkey")

            (plain_a, deep_a), (plain_b, deep_b) = deeper(probe, "a2", deep), deeper(index, "b2", 0)
            on = [*on, "sub", "subkey"]
            count = lambda df, n: df.groupBy(*on).agg(F.count(F.lit(1)).alias(n))
            work = materialize(count(deep_a, "m").join(count(deep_b, "n"), on).select(*on, (F.col("n") * F.col("m")).alias("work")), "loads")
            total += work.agg(F.sum("work")).first()[0] or 0
            probe, index = plain_a.unionByName(deep_a), plain_b.unionByName(deep_b)
            good &= (F.col("sub") < 0) | _first_band(F.col("a2"), F.col("b2"), F.col("sub"), cut, deep)
    probe, index = _salted(probe, index, on, work, crowded)
    on = [*on, "salt"]
    least = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, min(20_000, -(-int(total) // (5 * crowded))))
    pairs = probe.repartition(parts, *on).join(index.repartition(parts, *on).hint("shuffle_hash"), on).where(good)
    names = {"a1": f"{first}_l", "b1": f"{first}_r"} | ({"a2": f"{second}_l", "b2": f"{second}_r"} if second else {})
    return pairs.select(*(F.col(k).alias(v) for k, v in names.items()))


def _equal_bands(bits: int, rows: int) -> int:
    """Number of bands, of which all but ``bits`` must be equal, with the least work: a sort of the rows for each choice of equal bands, and the rows that agree in them."""
    return min(range(max(bits + 1, 2), bits + 6), key=lambda k: comb(k, k - bits) * (20 + 2 * rows / 2 ** (64 * (k - bits) / k)))


def _agreeing(v: np.ndarray, key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of equal ``key`` (sorted) whose values differ in at most ``bits`` bits, and some pairs of other keys."""
    ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
    sizes = np.diff(ends, prepend=0)
    rest = np.repeat(ends, sizes) - np.arange(1, len(key) + 1)  # later rows of the same key
    left, right, few = [], [], None
    for step in range(1, int(sizes.max())):
        if few is None and 4 * np.maximum(sizes - step, 0).sum() < len(v):
            few = np.flatnonzero(rest >= step)
        if few is None:
            at = np.flatnonzero(np.bitwise_count(v[step:] ^ v[:-step]) <= bits)
        else:
            few = few[rest[few] >= step]
            at = few[np.bitwise_count(v[few + step] ^ v[few]) <= bits]
        if len(at):
            left.append(at)
            right.append(at + step)
    none = np.empty(0, np.int64)
    return np.concatenate([*left, none]), np.concatenate([*right, none])


def _bucket_pairs(batches: Iterable[pa.RecordBatch], bits: int, bands: int) -> Iterator[pa.RecordBatch]:
    """Pairs of whole buckets ``unit, lo, hi, block, v``.

    A bucket has the values that agree in one band, the first of the ``bands - bits``
    equal ones that are looked at; in it the others are tried in turn. A pair counts only
    where these are its first equal bands, so it comes out once.
    """
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    cols = pa.Table.from_batches(batches)
    unit, lo, hi, block, v = (cols.column(c).to_numpy() for c in ("unit", "lo", "hi", "block", "v"))
    v, masks, equal = v.view(np.uint64), [np.uint64(m) for m in band_masks(bands)], bands - bits
    shifts = [np.uint64((int(m) & -int(m)).bit_length() - 1) for m in masks]
    order = np.lexsort((hi, lo, unit))
    new = np.flatnonzero((np.diff(unit[order]) != 0) | (np.diff(lo[order]) != 0) | (np.diff(hi[order]) != 0)) + 1
    for rows in np.split(order, new):
        if len(rows) < 2:
            continue
        first, split, values = int(unit[rows[0]] >> 40), lo[rows[0]] != hi[rows[0]], v[rows]
        for others in combinations(range(first + 1, bands), equal - 1):
            key, width = np.zeros(len(values), np.uint64), 0
            for j in others:
                wide = int(masks[j]).bit_count()
                key, width = (key << np.uint64(wide)) | ((values & masks[j]) >> shifts[j]), width + wide
            key = key.astype(np.uint16) if width <= 16 else key  # sorted by digits
            at = np.argsort(key, kind="stable")
            sorted_values = values[at]
            i, j = _agreeing(sorted_values, key[at], bits)
            if not len(i):
                continue
            x, path = sorted_values[i] ^ sorted_values[j], {first, *others}
            good = np.ones(len(x), bool)
            for band in range(max(path) + 1):
                good &= ((x & masks[band]) == 0) == (band in path)
            if split:
                cut = block[rows][at]
                good &= cut[i] != cut[j]
            a, b = sorted_values[i[good]].view(np.int64), sorted_values[j[good]].view(np.int64)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["l", "r"])


def _near_values(values: DataFrame, bits: int, bands: int | None = None, most: int = 1_000_000) -> DataFrame:
    """``l, r``: pairs of different values ``v`` (bigint, each once) with at most ``bits`` differing bits, the smaller at the left.

    Of ``bands`` bands all but ``bits`` are equal in such a pair, the first of them among
    the first ``bits + 1``, so a value is shuffled ``bits + 1`` times and all else is tried
    within the bucket. A bucket of more than ``most`` values is cut into blocks, and each
    two blocks meet in another task.
    """
    rows = values.count()
    bands = bands or _equal_bands(bits, rows)
    keys = [F.lit(i << 40).cast("bigint") + F.shiftrightunsigned(F.col("v").bitwiseAND(_long(m)), (m & -m).bit_length() - 1) for i, m in enumerate(band_masks(bands)[: bits + 1])]
    spread = values.select("v", F.explode(F.array(*keys)).alias("unit"))
    one = F.lit(0)
    spread, copies = spread.withColumns({"lo": one, "hi": one, "block": one}), rows * (bits + 1)
    if rows > most:
        crowded = spread.groupBy("unit").count().where(F.col("count") > most)
        crowded = materialize(crowded.select("unit", F.ceil(F.col("count") / most).cast("int").alias("blocks")), "crowded")
        if not crowded.isEmpty():
            cut = spread.drop("lo", "hi", "block").join(F.broadcast(crowded), "unit", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))  # fewer than bits + 1 in ``most`` rows
            cut = cut.withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            spread = cut.select("v", "unit", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block")
    least = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, min(20_000, -(-copies // 300_000)))
    work = partial(_bucket_pairs, bits=bits, bands=bands)
    return spread.repartition(parts, "unit", "lo", "hi").mapInArrow(work, "l bigint, r bigint")


def near_within(df: DataFrame, first: str, first_bits: int, second: str, second_bits: int, crowded: int = 4_000_000, bands: int | None = None, most: int = 1_000_000) -> DataFrame:
    """Pairs of different fingerprints of one table within both distances, each once.

    ``df`` and the result are as in ``hamming_join`` of a table with itself and ``halve``,
    without the pairs of a row with itself. The near values of ``first`` are found first,
    each once however many rows share it, with far fewer copies of the rows than probes
    of every change need; then the rows of each two values are compared. Two values whose
    rows have more than ``crowded`` comparisons are cut by bands of the second.
    """
    rows = materialize(df.select(F.col(first).alias("p"), F.col(second).alias("d")).where("p is not null and d is not null").distinct(), "near")
    values = materialize(rows.groupBy(F.col("p").alias("v")).agg(F.count(F.lit(1)).alias("n")), "values")
    same = values.where("n > 1").select(F.col("v").alias("l"), F.col("v").alias("r"))
    close = materialize(_near_values(values.select("v"), first_bits, bands, most).unionByName(same), "close")
    counted = close.join(values.toDF("l", "m"), "l").join(values.toDF("r", "n"), "r").withColumn("work", F.col("m") * F.col("n"))
    counted = materialize(counted.select("l", "r", "work"), "close")
    left, right = rows.toDF("l", "a2"), rows.toDF("r", "b1")
    good = (hamming(F.col("a2"), F.col("b1")) <= second_bits) & ((F.col("l") < F.col("r")) | (F.col("a2") < F.col("b1")))
    pairs = counted.where(F.col("work") <= crowded).drop("work").join(left, "l").join(right, "r").where(good).select("l", "a2", "r", "b1")
    hot = counted.where(F.col("work") > crowded).drop("work")
    if not hot.isEmpty():
        cut = best_bands(second_bits, 20_000)
        deep = second_bits // cut
        probe, index = _spread(hot.join(left, "l"), "a2", cut, deep, "sub", "subkey"), _spread(hot.join(right, "r"), "b1", cut, 0, "sub", "subkey")
        on = ["l", "r", "sub", "subkey"]
        count = lambda x, n: x.groupBy(*on).agg(F.count(F.lit(1)).alias(n))
        work = materialize(count(probe, "m").join(count(index, "n"), on).select(*on, (F.col("n") * F.col("m")).alias("work")), "loads")
        total = work.agg(F.sum("work")).first()[0] or 0
        probe, index = _salted(probe, index, on, work, crowded)
        on = [*on, "salt"]
        parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(20_000, -(-int(total) // (5 * crowded))))
        met = probe.repartition(parts, *on).join(index.repartition(parts, *on).hint("shuffle_hash"), on)
        pairs = pairs.unionByName(met.where(good & _first_band(F.col("a2"), F.col("b1"), F.col("sub"), cut, deep)).select("l", "a2", "r", "b1"))
    return pairs.toDF(f"{first}_l", f"{second}_l", f"{first}_r", f"{second}_r")
