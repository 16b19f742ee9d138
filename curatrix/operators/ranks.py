"""Exact global positions and ranks without a window over one partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def global_positions(df: DataFrame, order: list[str | Column], name: str = "position", weight: str | dict[str, str] | None = None) -> DataFrame:
    """Add the 0-based position of each row in the total order ``order``.

    The rows are range-partitioned and sorted; the rows of a partition are counted,
    and each partition gets the sum of the counts before it as its offset. Only the
    counts (one row a partition) are gathered. ``order`` should end in a unique
    column: equal keys stay in one range partition.

    With ``weight`` the position is the sum of that column over all earlier rows
    (the rows then stand for ``weight`` records each; the weights of a partition are
    added up within the partition). A dict of names and columns gives several such sums
    from one sort, and ``name`` is not used.

    Nulls sort first as in Spark. An empty input gives an empty output. A column
    called ``name`` already in ``df`` is replaced.
    """
    sums = weight if isinstance(weight, dict) else {name: weight} if weight else {}
    keep = [c for c in df.columns if c not in (sums or {name: None})]
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    row, part = "__row", "__part"
    placed = df.select(*keep).repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(row, F.monotonically_increasing_id())
    placed = placed.withColumn(part, F.shiftright(row, _ROW_BITS))
    if not sums:
        placed = placed.withColumn("__before0", F.col(row).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        placed = materialize(placed.drop(row), "positions")
        totals = placed.groupBy(part).agg(F.count(F.lit(1)).alias("__n0"))
    else:
        placed = materialize(placed, "positions")
        inside = Window.partitionBy(part).orderBy(row).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        totals = placed.groupBy(part).agg(*(F.sum(w).alias(f"__n{i}") for i, w in enumerate(sums.values())))
        placed = placed.withColumns({f"__before{i}": F.sum(w).over(inside) - F.col(w) for i, w in enumerate(sums.values())}).drop(row)
    names = list(sums) or [name]
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = totals.select(part, *(F.coalesce(F.sum(f"__n{i}").over(before), F.lit(0)).cast("long").alias(f"__offset{i}") for i in range(len(names))))
    return (
        placed.join(F.broadcast(offsets), part)  # bounded by the number of partitions
        .select(*keep, *((F.col(f"__before{i}") + F.col(f"__offset{i}")).cast("long").alias(n) for i, n in enumerate(names)))
    )
