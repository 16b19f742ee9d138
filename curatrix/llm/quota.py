"""Problem 3: a sample of each batch that meets target shares of several fields.

Weights are raked to all target shares over the cells of images with the same target
values; images are drawn by weighted exponential keys; minimum counts and shares that the
draw misses are repaired by swaps between cells; a report says what can't be met.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.llm.names import id_key, word_key
from curatrix.session import materialize

FIELDS = ("CandidateCategory", "MatchedClasses")
ACCEPTED = "accepted_negative"
CLOSE = 1e-4  # a weighted share this near its target meets it


def _plain(text: Column) -> Column:
    """Lower case without blanks; null if nothing is left."""
    return F.nullif(F.regexp_replace(F.lower(text), r"\s+", ""), F.lit(""))


def _value_key(field: Column, value: Column) -> Column:
    return F.when(field == FIELDS[0], word_key(value)).when(field == FIELDS[1], _plain(value))


def ask_table(targets: DataFrame) -> DataFrame:
    """One row a target: batch, field, value, key, share, floor, size and ``ask``, the larger of the minimum and share * size rounded half up.

    Null shares, minimums and sizes count as 0; rows without batch, field or value are ignored; of repeated targets the largest counts.
    """
    rows = targets.where("negative_batch is not null and target_field is not null and target_value is not null").select(
        F.col("negative_batch").alias("batch"),
        F.col("target_field").alias("field"),
        F.col("target_value").alias("value"),
        _value_key(F.col("target_field"), F.col("target_value")).alias("key"),
        F.coalesce("target_share", F.lit(0.0)).alias("share"),
        F.coalesce("min_count", F.lit(0)).alias("floor"),
        F.coalesce("sample_size", F.lit(0)).alias("size"),
    )
    top = [F.max(c).alias(c) for c in ("key", "share", "floor", "size")]
    rows = rows.groupBy("batch", "field", "value").agg(*top)
    return rows.withColumn("ask", F.greatest(F.col("floor"), F.round(F.col("share") * F.col("size")).cast("int")))


def _deletions(text: Column) -> Column:
    """The text and the text without each one of its letters: texts one slip apart share one of these."""
    at = F.sequence(F.lit(1), F.length(text))
    return F.array_distinct(F.concat(F.array(text), F.transform(at, lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))))


def slip_map(spellings: DataFrame, values: DataFrame) -> DataFrame:
    """Columns ``spelling, key``: each distinct spelling with every value at most one inserted, dropped or replaced letter away.

    Both inputs have one column of keys. An equi-join on the texts with one letter
    left out finds the candidates, so it is no cross join of spellings and values.
    """
    a = spellings.toDF("spelling").where("spelling is not null").distinct()
    b = values.toDF("key").where("key is not null").distinct()
    a = a.select("spelling", F.explode(_deletions(F.col("spelling"))).alias("part"))
    b = b.select("key", F.explode(_deletions(F.col("key"))).alias("part"))
    return a.join(b, "part").where(F.levenshtein("spelling", "key") <= 1).select("spelling", "key").distinct()


def carried_values(images: DataFrame, asks: DataFrame) -> DataFrame:
    """Distinct ``batch, image, field, value``: accepted images and the targets of their batch that they carry.

    An image is its id without case, blanks and extension. Category and classes of all
    its accepted rows in the batch count. Classes are separated by ``; , |`` or ``/``.
    """
    rows = images.where(_plain(F.col("ReviewStatus")) == ACCEPTED).select(
        F.col("NegativeBatch").alias("batch"),
        id_key(F.regexp_replace(F.col("ImageID"), r"\s+", "")).alias("image"),
        word_key(F.col("CandidateCategory")).alias("category"),
        F.split(F.coalesce("MatchedClasses", F.lit("")), r"[;,|/]").alias("classes"),
    ).where("batch is not null and image is not null")
    rows = rows.groupBy("batch", "image", "category", "classes").agg(F.lit(1).alias("one"))
    slips = slip_map(rows.select("category"), asks.where(F.col("field") == FIELDS[0]).select("key"))
    category = rows.select("batch", "image", F.col("category").alias("spelling")).join(slips, "spelling").select("batch", "image", F.lit(FIELDS[0]).alias("field"), "key")
    classes = rows.select("batch", "image", F.explode("classes").alias("c")).select("batch", "image", F.lit(FIELDS[1]).alias("field"), _plain(F.col("c")).alias("key"))
    return category.unionByName(classes).join(asks.select("batch", "field", "key", "value"), ["batch", "field", "key"]).select("batch", "image", "field", "value").distinct()


def supply_report(images: DataFrame, targets: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """Each target with ``ask`` and ``supply``, the distinct accepted images of its batch that carry the value.

    Columns ``negative_batch, target_field, target_value, ask, supply``. A target
    nobody carries has supply 0; without targets the result is empty. Columns other
    than those of the two tables that are named here are ignored. ``carried`` may hold
    ``carried_values`` of the same tables if they are at hand.
    """
    asks = ask_table(targets)
    have = (carried_values(images, asks) if carried is None else carried).groupBy("batch", "field", "value").agg(F.count(F.lit(1)).alias("supply"))
    return asks.join(have, ["batch", "field", "value"], "left").select(
        F.col("batch").alias("negative_batch"), F.col("field").alias("target_field"), F.col("value").alias("target_value"), "ask", F.coalesce("supply", F.lit(0)).cast("long").alias("supply")
    )


def rake(counts: np.ndarray, carries: np.ndarray, shares: np.ndarray, rounds: int | None = None, close: float = CLOSE) -> np.ndarray:
    """Weight of an image of each cell so that each target's weighted share is its target, as far as supply allows.

    ``carries[c, t]`` tells whether cell c carries target t. The weights are the limit of
    proportional fitting, the ones nearest to the counts that meet all shares; where none
    do, the sum of the squared gaps is least. Both are the minimum of one strictly convex
    function, found by damped Newton steps until its slope is gone; there is no limit of
    steps unless ``rounds`` sets one. Targets that no image or every image carries, and
    shares of 0 or 1, move no weight.
    """
    own = counts @ carries
    free = (own > 0) & (own < counts.sum()) & (shares > 0) & (shares < 1)
    has, want, ridge = carries[:, free].astype(float), shares[free], close / 100  # the ridge keeps the minimum finite where shares are out of reach
    pull, base = np.zeros(len(want)), np.log(np.maximum(counts, 1e-300))

    def at(pull: np.ndarray) -> tuple[np.ndarray, float]:
        logs = base + has @ pull
        top = logs.max(initial=-np.inf)
        mass = np.exp(logs - top)
        return mass / mass.sum(), float(top + np.log(mass.sum()) - pull @ want + ridge / 2 * (pull @ pull))

    part, value = at(pull) if len(counts) else (base, 0.0)
    done = 0
    while len(want) and (rounds is None or done < rounds):
        done += 1
        reach = part @ has
        slope = reach - want + ridge * pull
        if np.abs(slope).max() < close / 1000:
            break
        step = np.linalg.solve((has.T * part) @ has - np.outer(reach, reach) + ridge * np.eye(len(want)), -slope)
        length, fall = 1.0, slope @ step
        while (new := at(pull + length * step))[1] > value + 1e-4 * length * fall and length > 1e-12:
            length /= 2
        if not new[1] < value:  # lowest as far as doubles can tell
            break
        pull, (part, value) = pull + length * step, new
    logs = has @ pull
    return np.maximum(np.exp(logs - logs.max(initial=-np.inf)), 1e-9)


CELLS = "array<struct<profile: array<string>, number: double>>"
_CELLS = pa.list_(pa.struct([("profile", pa.list_(pa.string())), ("number", pa.float64())]))
PATIENCE, RESTARTS = 60, 40  # swaps without a smaller gap after which a search ends, and searches from other compositions if a gap is left


def repair(have: np.ndarray, drawn: np.ndarray, carries: np.ndarray, floors: np.ndarray, asks: np.ndarray, patience: int = PATIENCE, restarts: int = RESTARTS) -> np.ndarray:
    """Images to take of each cell, as many in all as ``drawn``: by swaps until no minimum or ask is missed that can be mended.

    ``have[c]`` images carry what ``carries[c]`` says, of which ``drawn[c]`` were drawn. A
    missed minimum weighs more than any missed asks. Every step makes the best swap of an
    image of one cell for one of another, also where the gap stays the same or grows, but
    not of a cell that has just given or taken; the best composition seen counts. A search
    that leaves a gap is repeated from compositions of which half is drawn anew, the same
    ones in every run.
    """
    supply = have @ carries
    floors, asks = np.minimum(floors, supply), np.minimum(np.maximum(floors, asks), supply)
    heavy = asks.sum() + 1.0

    def gaps(count: np.ndarray) -> np.ndarray:
        return np.maximum(asks - count, 0).sum(-1) + heavy * np.maximum(floors - count, 0).sum(-1)

    best, least = _search(have, drawn, carries, asks, gaps, heavy, patience)
    chance = np.random.default_rng(11)
    for _ in range(restarts):
        if least <= 0:
            break
        start = chance.multivariate_hypergeometric(best, best.sum() // 2)
        start += chance.multivariate_hypergeometric(have - start, best.sum() - start.sum())
        found, gap = _search(have, start, carries, asks, gaps, heavy, patience)
        if gap < least:
            best, least = found, gap
    return best


def _search(have: np.ndarray, start: np.ndarray, carries: np.ndarray, asks: np.ndarray, gaps: Callable, heavy: float, patience: int) -> tuple[np.ndarray, float]:
    """The best composition met on the way from ``start``, and its gap."""
    now, count = start.copy(), start @ carries
    best, least = now.copy(), gaps(count)
    barred = np.zeros(len(have), int)  # step until which a cell may not change
    step = since = 0
    while least > 0 and since < patience:
        step, since = step + 1, since + 1
        give, take = np.flatnonzero((now > 0) & (barred < step)), np.flatnonzero((now < have) & (barred < step))
        wanted = take[carries[take][:, asks > count].any(1)]
        take = wanted if len(wanted) else take
        found = None
        for a in range(0, len(take) if len(give) else 0, 64):  # a block of cells at a time bounds the memory
            part = take[a : a + 64]
            new = count - carries[give][:, None, :] + carries[part][None, :, :]
            cost = gaps(new) + np.maximum(new - asks, 0).max(-1, initial=0) / (4 * heavy)
            cost[give[:, None] == part[None, :]] = np.inf
            g, t = np.unravel_index(cost.argmin(), cost.shape)
            if cost[g, t] < (found[0] if found else np.inf):
                found = cost[g, t], give[g], part[t]
        if found is None:
            continue  # cells are barred for a few steps only
        _, g, t = found
        now[g], now[t] = now[g] - 1, now[t] + 1
        count = count - carries[g] + carries[t]
        barred[[g, t]] = step + 3
        if gaps(count) < least:
            best, least, since = now.copy(), gaps(count), 0
    return best, float(least)


def _carries(profiles: list, names: list[str]) -> np.ndarray:
    return np.array([[n in p for n in names] for p in map(set, profiles)], dtype=bool).reshape(len(profiles), len(names))


def _per_batch(cells: DataFrame, asks: DataFrame, solve: Callable) -> DataFrame:
    """``batch, profile, number``: ``solve(cells, asks)`` gives a number for each cell of a batch.

    A batch is one row of its cells (at most as many as its targets can combine, never
    its images) and its targets. Partitions are set by number, as a few bytes may hold
    many batches, which would otherwise end in one task.
    """
    rows = cells.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("profile", *(c for c in cells.columns if c not in ("batch", "profile"))))).alias("cells"))
    goals = asks.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct(F.concat_ws("=", "field", "value").alias("tag"), "share", "floor", "ask"))).alias("asks"))
    # by a hash of the batch, as a repartition by the key of the aggregation itself may be planned away
    rows = rows.join(goals, "batch").repartition(2 * cells.sparkSession.sparkContext.defaultParallelism, F.xxhash64("batch"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [
                [{"profile": c["profile"], "number": float(x)} for c, x in zip(own, solve(own, goal))]
                for own, goal in zip(b.column(1).to_pylist(), b.column(2).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, _CELLS)], ["batch", "cells"])

    return rows.select("batch", "cells", "asks").mapInArrow(scan, f"batch int, cells {CELLS}").select("batch", F.inline("cells"))


def _rake_cells(cells: list[dict], asks: list[dict]) -> np.ndarray:
    carries = _carries([c["profile"] for c in cells], [a["tag"] for a in asks])
    return rake(np.array([c["n"] for c in cells]), carries, np.array([a["share"] for a in asks], dtype=float))


def _repair_cells(cells: list[dict], asks: list[dict]) -> np.ndarray:
    carries = _carries([c["profile"] for c in cells], [a["tag"] for a in asks]).astype(int)
    have, drawn = (np.array([c[k] for c in cells]) for k in ("have", "drawn"))
    return repair(have, drawn, carries, *(np.array([a[k] for a in asks]) for k in ("floor", "ask")))


def raked_cells(images: DataFrame, targets: DataFrame, carried: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted images of the batches with targets: ``batch, image, profile, size``; cells: ``batch, profile, n, weight``), both written."""
    asks = materialize(ask_table(targets), "asks")
    carried = carried_values(images, asks) if carried is None else carried
    accepted = images.where(_plain(F.col("ReviewStatus")) == ACCEPTED).select(
        F.col("NegativeBatch").alias("batch"), id_key(F.regexp_replace(F.col("ImageID"), r"\s+", "")).alias("image")
    ).where("batch is not null and image is not null").distinct()
    tags = carried.groupBy("batch", "image").agg(F.array_sort(F.collect_set(F.concat_ws("=", "field", "value"))).alias("profile"))
    sizes = asks.groupBy("batch").agg(F.max("size").alias("size"))
    tagged = accepted.join(tags, ["batch", "image"], "left").withColumn("profile", F.coalesce("profile", F.array().cast("array<string>")))
    tagged = materialize(tagged.join(sizes, "batch"), "tagged")
    cells = materialize(tagged.groupBy("batch", "profile").agg(F.count(F.lit(1)).alias("n")), "cells")
    weights = _per_batch(cells, asks, _rake_cells).withColumnRenamed("number", "weight")
    return tagged, materialize(cells.join(weights, ["batch", "profile"]), "weights")


def target_sample(
    images: DataFrame, targets: DataFrame, seed: str = "quota", salt_rows: int = 50_000, carried: DataFrame | None = None, cells: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Columns ``negative_batch, image, profile, draw_order, repaired``: the sample of each batch.

    ``profile`` has the target values an image carries as ``field=value``. Images of a
    batch without targets, and batches without accepted images, give nothing. A batch
    with fewer images than its sample size is taken whole. The result depends on the
    ids and the seed only, so ties and the order of rows make no difference.

    Raking and repair see the cells of a batch (distinct profiles) and never its images:
    ``repair`` says how many images of each cell to take, and those first in the order of
    the weighted exponential keys are taken; ``repaired`` marks images that the draw alone
    would have left out. No more than ``sample_size`` images of a cell can be needed; they
    come from salted windows of about ``salt_rows`` rows, so a batch or a cell that holds a
    third of all rows is not gathered in one task. ``cells`` may hold ``raked_cells`` of
    the same tables if they are at hand.
    """
    asks = materialize(ask_table(targets), "asks")
    tagged, weights = raked_cells(images, targets, carried) if cells is None else cells
    even = (F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(seed), "batch", "image"), 256), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    keyed = tagged.join(weights.drop("n"), ["batch", "profile"]).withColumn("sort_key", -F.ln(even) / F.col("weight"))
    largest = weights.agg(F.max("n")).first()[0] or 0
    salt = F.pmod(F.xxhash64("image"), F.lit(max(1, -(-largest // salt_rows)))).cast("int")
    pool = keyed.withColumn("salt", salt).drop("weight")
    for by in (["batch", "profile", "salt"], ["batch", "profile"]):
        pool = pool.withColumn("in_cell", F.row_number().over(Window.partitionBy(*by).orderBy("sort_key", "image"))).where("in_cell <= size")
    first = Window.partitionBy("batch").orderBy("sort_key", "image")  # the cells of a batch times its sample size at most
    pool = materialize(pool.withColumn("drawn", F.row_number().over(first) <= F.col("size")).drop("salt"), "pool")
    counts = pool.groupBy("batch", "profile").agg(F.count(F.lit(1)).alias("have"), F.count_if("drawn").alias("drawn"))
    takes = _per_batch(counts, asks, _repair_cells).where("number > 0")
    rows = pool.join(takes, ["batch", "profile"]).where("in_cell <= number")
    return rows.select(F.col("batch").alias("negative_batch"), "image", "profile", F.row_number().over(first).alias("draw_order"), (~F.col("drawn")).alias("repaired"))


def sample_report(
    sample: DataFrame, images: DataFrame, targets: DataFrame, carried: DataFrame | None = None, cells: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Each target with ask, supply, sampled images, their share, the gap to the ask, whether supply can meet it, and the raked share.

    ``raked_share`` is the target's share of the weights and ``share_met`` whether it is the
    target share (a share of 0 asks nothing): where it is false, the shares of the batch
    cannot be met together, even if ``can_be_met`` holds for each alone.
    """
    sampled = sample.select("negative_batch", F.explode("profile").alias("tag")).groupBy("negative_batch", "tag").agg(F.count(F.lit(1)).alias("sampled"))
    sizes = sample.groupBy("negative_batch").agg(F.count(F.lit(1)).alias("sample_rows"))
    weights = (raked_cells(images, targets, carried) if cells is None else cells)[1].withColumn("mass", F.col("n") * F.col("weight"))
    masses = weights.groupBy("batch").agg(F.sum("mass").alias("batch_mass"))
    raked = weights.select("batch", F.explode("profile").alias("tag"), "mass").groupBy("batch", "tag").agg(F.sum("mass").alias("mass")).join(masses, "batch")
    raked = raked.select(F.col("batch").alias("negative_batch"), "tag", (F.col("mass") / F.col("batch_mass")).alias("raked"))
    wanted = ask_table(targets).select(F.col("batch").alias("negative_batch"), F.concat_ws("=", "field", "value").alias("tag"), F.col("share").alias("wanted"))
    rows = supply_report(images, targets, carried).withColumn("tag", F.concat_ws("=", "target_field", "target_value"))
    rows = rows.join(wanted, ["negative_batch", "tag"]).join(sampled, ["negative_batch", "tag"], "left").join(raked, ["negative_batch", "tag"], "left").join(sizes, "negative_batch", "left")
    got, reach = F.coalesce("sampled", F.lit(0)).cast("long"), F.coalesce("raked", F.lit(0.0))
    return rows.select(
        "negative_batch", "target_field", "target_value", "ask", "supply", got.alias("sampled"),
        F.round(F.coalesce(F.try_divide(got, F.col("sample_rows")), F.lit(0.0)), 6).alias("share"),
        F.greatest(F.col("ask") - got, F.lit(0)).alias("gap"),
        (F.col("supply") >= F.col("ask")).alias("can_be_met"),
        F.round(reach, 6).alias("raked_share"), ((F.col("wanted") <= 0) | (F.abs(reach - F.col("wanted")) < CLOSE)).alias("share_met"),
    )


def sample_invariants(sample: DataFrame, images: DataFrame, targets: DataFrame) -> DataFrame:
    """What must hold of any sample, one row for each batch with targets and accepted images.

    ``negative_batch, sample_rows, distinct_images, not_accepted`` (sampled images that are
    no accepted ones of the batch) and ``missed_floors`` (targets with fewer sampled images
    than their minimum although supply would allow it).
    """
    accepted = images.where(_plain(F.col("ReviewStatus")) == ACCEPTED).select(
        F.col("NegativeBatch").alias("negative_batch"), id_key(F.regexp_replace(F.col("ImageID"), r"\s+", "")).alias("image"), F.lit(True).alias("known")
    ).where("negative_batch is not null and image is not null").distinct()
    per = sample.join(accepted, ["negative_batch", "image"], "left").groupBy("negative_batch").agg(
        F.count(F.lit(1)).alias("sample_rows"), F.count_distinct("image").alias("distinct_images"), F.count_if(F.col("known").isNull()).alias("not_accepted")
    )
    got = sample.select("negative_batch", F.explode("profile").alias("tag")).groupBy("negative_batch", "tag").agg(F.count(F.lit(1)).alias("sampled"))
    floors = ask_table(targets).select(F.col("batch").alias("negative_batch"), F.concat_ws("=", "field", "value").alias("tag"), "floor")
    supply = supply_report(images, targets).select("negative_batch", F.concat_ws("=", "target_field", "target_value").alias("tag"), "supply")
    lines = floors.join(supply, ["negative_batch", "tag"]).join(got, ["negative_batch", "tag"], "left")
    missed = lines.groupBy("negative_batch").agg(F.count_if(F.coalesce("sampled", F.lit(0)) < F.least("floor", "supply")).alias("missed_floors"))
    return per.join(missed, "negative_batch")
