"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from curatrix.session import forget, materialize


def _written(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edges as a table, with their number and a sum of hashes that the writing job takes along."""
    seen = Observation()
    total = F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))
    table = materialize(edges.observe(seen, F.count(F.lit(1)).alias("n"), total.alias("h")), "edges")
    return table, (int(seen.get["n"]), int(seen.get["h"]))


def connected_components(edges: DataFrame, left: str = "u", right: str = "v", max_rounds: int = 60) -> DataFrame:
    """Columns ``node`` and ``component`` (the smallest node of the component).

    ``edges`` holds undirected links in two columns of one comparable type, in any
    order and repeated at will; links with a null end and links of a node to itself
    are ignored, and a node without a link doesn't appear. Each round is one
    aggregation and one join on the nodes, so no component is ever gathered; a hub
    is pre-aggregated map-side and its join is left to the skew handling of adaptive
    execution. The edges of a round are written to the shared folder, which cuts the
    lineage. The number of rounds grows with the logarithm of the longest path.
    """
    ends = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")  # drops nulls as well
    now = ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, seen = _written(now)
    for _ in range(max_rounds):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        after, stamp = _written(small.union(down.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct())
        forget(now)
        now = after
        if stamp == seen:
            break
        seen = stamp
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
