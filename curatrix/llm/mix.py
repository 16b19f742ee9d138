"""Problem 6: mixing sources to target weights of tokens.

Each source needs its weight of the total tokens, so each of its documents is wanted a
fractional number of times, at most ``max_repeats``. What sources that run out leave open
is shared by the others in proportion to their weights. The whole part is given to all; the
fractional parts are rounded by the pivotal method: two documents at a time pass tokens
from one to the other, in the random direction that keeps both expectations, until one
of them is wanted a whole number of times. Within a leaf of some thousand documents all
pairs of a round are rounded at once, which leaves at most one; what is left of the
leaves is paired in a tree, level by level.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curatrix.llm.names import word_key
from curatrix.session import materialize

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that cuts a text into pieces for this vocabulary.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def with_tokens(documents: DataFrame, text: str = "text", name: str = "tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """The table with ``text`` replaced by its number of tokens; null and empty texts have 0. Texts are read whole, not cut."""
    cols = [c for c in documents.columns if c not in (text, name)]
    types = dict(documents.dtypes)
    ddl = ", ".join(f"`{c}` {types[c]}" for c in cols) + f", `{name}` long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(tokenizer).encode_ordinary
        for b in batches:
            n = pa.array([len(encode(t)) if t else 0 for t in b.column(len(cols)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(cols)], n], [*cols, name])

    return documents.select(*cols, text).mapInArrow(count, ddl)


def mix_plan(totals: DataFrame, targets: DataFrame) -> DataFrame:
    """One row a target source: ``source, source_key, target_weight, max_repeats, documents, tokens, wanted, rate, falls_short, planned``.

    ``totals(source_key, documents, tokens)`` are of the documents of listed sources.
    ``wanted`` is the weight times all their tokens; a source falls short if its tokens
    times ``max_repeats`` are fewer. ``planned`` are the tokens it shall give: all it can
    if that is less than its part, else its weight times one factor, the same for all
    other sources, with which the plan has as many tokens as wanted in all (or all there
    are). ``rate`` is planned by tokens, how often a document is wanted on average. A
    source without tokens has rate 0 and falls short unless nothing is wanted of it.
    Null weights count as 0 and null repeats as 1.
    """
    listed = targets.where("source is not null").select(
        "source", word_key(F.col("source")).alias("source_key"), F.coalesce("target_weight", F.lit(0.0)).alias("target_weight"), F.coalesce("max_repeats", F.lit(1)).alias("max_repeats")
    )
    rows = listed.join(totals, "source_key", "left").na.fill(0, ["documents", "tokens"])
    everything = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("everything"))
    rows = rows.crossJoin(F.broadcast(everything)).withColumn("wanted", F.col("target_weight") * F.col("everything"))  # one row
    # by rising need: while a source has less than the factor that the sources before it leave open asks of it, the factor
    # rises from one to the next, and falls after that; so the largest is the one that all others share
    most = F.col("tokens") * F.col("max_repeats")
    need = F.when(F.col("target_weight") > 0, most / F.col("target_weight"))
    before, after = (Window.orderBy("need", "source").rowsBetween(*x) for x in ((Window.unboundedPreceding, -1), (0, Window.unboundedFollowing)))  # the targets' rows
    rows = rows.withColumns({"most": most, "need": need}).where("need is not null").unionByName(rows.withColumns({"most": most, "need": F.lit(None).cast("double")}).where("target_weight <= 0"))
    whole = F.sum("wanted").over(Window.partitionBy())
    open_tokens = whole - F.coalesce(F.sum(F.when(F.col("need").isNotNull(), F.col("most"))).over(before), F.lit(0))
    factor = F.try_divide(open_tokens, F.sum(F.when(F.col("need").isNotNull(), F.col("target_weight"))).over(after))
    rows = rows.withColumn("factor", factor).withColumn("level", F.max("factor").over(Window.partitionBy()))
    planned = F.when(F.col("need").isNull(), F.lit(0.0)).otherwise(F.least(F.col("most").cast("double"), F.coalesce(F.col("level") * F.col("target_weight"), F.col("most").cast("double"))))
    rows = rows.withColumn("planned", planned)
    return rows.select(
        "source", "source_key", "target_weight", "max_repeats", "documents", "tokens", "wanted",
        F.least(F.col("max_repeats").cast("double"), F.coalesce(F.try_divide("planned", "tokens"), F.lit(0.0))).alias("rate"),
        (most < F.col("wanted")).alias("falls_short"), "planned",
    )


def _even(keys: np.ndarray, seed: int, level: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the keys, the seed and the level."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + level * 0xD1B54A32D192ED03) % 2**64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))).astype(np.float64) + 0.5) / 2.0**64


def pivot(keys: np.ndarray, mass: np.ndarray, part: np.ndarray, seed: int, level: int) -> np.ndarray:
    """The parts after the rounds: 0.0 or 1.0 for all but at most one, the sum of mass * part kept.

    A round pairs the fractional parts in their order, all pairs at once; at least one of
    each pair becomes whole, so the rounds are about the logarithm of the rows.
    """
    out, eps = np.array(part, dtype=float), 1e-9
    whole = lambda x: np.where(x <= eps, 0.0, np.where(x >= 1 - eps, 1.0, x))
    out, turn = whole(out), 0
    while len(at := np.flatnonzero((out > 0) & (out < 1))) > 1:
        i, k = at[0 : len(at) - 1 : 2], at[1::2]
        a, b = mass[i].astype(float), mass[k].astype(float)
        up = np.minimum((1 - out[i]) * a, out[k] * b)  # tokens that may pass from k to i
        down = np.minimum(out[i] * a, (1 - out[k]) * b)
        shift = np.where(_even(keys[i], seed, level * 64 + turn) * (up + down) < down, up, -down)
        out[i], out[k] = whole(out[i] + shift / a), whole(out[k] - shift / b)
        turn += 1
    return out


def mix(documents: DataFrame, targets: DataFrame, seed: int = 5, leaf_rows: int = 20_000, fan: int = 512, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, source, tokens, copies`` of the documents in the mixture, the plan of ``mix_plan``).

    Documents belong to a source if they differ from it only in letter case, blanks and
    separators; others are left out. ``copies`` is at most ``max_repeats`` and at least
    1. Documents without tokens (null, empty) add nothing and are left out. The tokens
    of a source differ from what its plan asks by less than one document. The draw
    depends on ids, seed and the number of documents of a source; the leaves follow that
    number, so which documents are drawn changes as a source grows, its share doesn't.
    Equal doc_ids are drawn in one order but apart.

    Only fractional parts go through Python, in leaves of about ``leaf_rows`` documents, as
    many for a source of a third of all rows as it needs; a level of the tree joins ``fan``
    leaves, each with one document. The driver gets the plan, one row a target.
    """
    listed = targets.where("source is not null").select(word_key(F.col("source")).alias("source_key")).distinct()
    mine = documents.select("doc_id", word_key(F.col("source")).alias("source_key"), "text").join(F.broadcast(listed), "source_key", "left_semi")
    counted = materialize(with_tokens(mine, tokenizer=tokenizer), "tokens")
    totals = counted.groupBy("source_key").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"))
    plan = materialize(mix_plan(totals, targets), "plan")
    lines = plan.select("source", "source_key", F.floor("rate").cast("int").alias("whole"), (F.col("rate") - F.floor("rate")).alias("part"), F.greatest(F.lit(1), F.ceil(F.col("documents") / leaf_rows)).cast("int").alias("leaves"))
    leaves = lines.agg(F.max("leaves")).first()[0] or 1
    kind = dict(counted.dtypes)["doc_id"]
    schema = f"doc_id {kind}, source string, tokens long, whole int, part double, leaf int, key long"
    spread = 2 * documents.sparkSession.sparkContext.defaultParallelism
    fraction = (F.col("part") > 0) & (F.col("part") < 1)

    def level(rows: DataFrame, number: int) -> DataFrame:
        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["key", "doc_id", "tokens"], ignore_index=True)
            pdf["part"] = pivot(pdf["key"].to_numpy(), pdf["tokens"].to_numpy(), pdf["part"].to_numpy(), seed, number)
            return pdf

        return materialize(rows.repartition(spread, "source", "leaf").groupBy("source", "leaf").applyInPandas(one, schema), f"pivot{number}")

    key = F.xxhash64("doc_id", F.lit(seed))
    rows = counted.where("tokens > 0").join(F.broadcast(lines), "source_key").select("doc_id", "source", "tokens", "whole", "part", F.pmod(key, F.col("leaves")).cast("int").alias("leaf"), key.alias("key"))
    done, rows, number = rows.where(~fraction), rows.where(fraction), 0
    while True:
        rows = level(rows, number)
        done = done.unionByName(rows.where(~fraction))
        rows = rows.where(fraction)
        if leaves == 1:
            break
        leaves, number = -(-leaves // fan), number + 1
        rows = rows.withColumn("leaf", F.floor(F.col("leaf") / fan).cast("int"))
    # at most one document a source
    last = (F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string")), 256), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    done = done.unionByName(rows.withColumn("part", (last < F.col("part")).cast("double")))
    copies = (F.col("whole") + F.col("part")).cast("int")
    return done.select("doc_id", "source", "tokens", copies.alias("copies")).where("copies > 0"), plan


def mix_report(mixture: DataFrame, plan: DataFrame) -> DataFrame:
    """``source, target_weight, planned_share, actual_share, documents, copies, planned_tokens, mixed_tokens, falls_short`` for each target source."""
    used = mixture.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("copies").alias("copies"), F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens")
    )
    rows = plan.select("source", "target_weight", "falls_short", "planned").join(used, "source", "left").na.fill(0, ["documents", "copies", "mixed_tokens"])
    total = rows.agg(F.sum("mixed_tokens").alias("total"), F.sum("planned").alias("all_planned"))
    share = lambda a, b: F.round(F.coalesce(F.try_divide(a, b), F.lit(0.0)), 6)
    return rows.crossJoin(F.broadcast(total)).select(  # one row
        "source", "target_weight", share("planned", "all_planned").alias("planned_share"), share("mixed_tokens", "total").alias("actual_share"),
        "documents", "copies", F.round("planned", 3).alias("planned_tokens"), "mixed_tokens", "falls_short",
    )
