"""Exact duplicate groups, adjudication and duplicate assessment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exact_groups(df: DataFrame, digest: str, group: str) -> DataFrame:
    """Rows whose ``digest`` occurs at least twice, with ``group_id``, ``members``, ``groups`` and ``crosses_groups``.

    The group sizes are aggregated first (map-side) and joined back, so a digest that
    a third of all rows share isn't gathered in one window; adaptive execution splits
    its join. ``groups`` counts the distinct non-null values of ``group``. Rows with a
    null digest have no duplicates. Columns of these names in ``df`` are replaced.
    """
    new = ("group_id", "members", "groups", "crosses_groups")
    rows = df.select(*(c for c in df.columns if c not in new)).where(F.col(digest).isNotNull())
    sizes = rows.groupBy(digest, group).count().groupBy(digest).agg(F.sum("count").alias("members"), F.count(group).alias("groups")).where("members >= 2")
    return rows.join(sizes, digest).withColumns({
        "group_id": F.concat(F.lit("exact__"), F.substring(digest, 1, 16)),
        "crosses_groups": F.col("groups") > 1,
    })
