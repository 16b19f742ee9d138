"""Problem 2: splits that keep related records together.

Related groups are joined into units (connected components of the confirmed links).
Units of one size and label profile are one bundle; a min-cost flow decides how many
records of each bundle go to each split, where records beyond a quota of a split or of
a label within a split cost; the flow is rounded to whole units; the units of a bundle
are dealt out in the order of their hashes.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.llm.names import group_key, id_key, is_included, split_key, trimmed
from curatrix.operators.components import connected_components
from curatrix.operators.ranks import global_positions
from curatrix.session import materialize

SPLITS = ("train", "val", "test")
LINK_COLUMNS = ("source_dataset_a", "source_group_a", "source_dataset_b", "source_group_b", "link_status", "reviewed_at")


def confirmed_links(links: DataFrame) -> DataFrame:
    """Columns ``u, v``: unordered pairs of group keys whose latest decision is confirmed.

    Sides may come in either order and any spelling. The latest row of a pair by
    ``reviewed_at`` decides (a null time is the earliest); a blank or null status is
    not confirmed, and of decisions at one moment all must be. A pair with a missing
    or placeholder group, or of a group with itself, is ignored.
    """
    a = group_key(F.col("source_dataset_a"), F.col("source_group_a"))
    b = group_key(F.col("source_dataset_b"), F.col("source_group_b"))
    rows = links.select(a.alias("a"), b.alias("b"), (F.lower(trimmed(F.col("link_status"))) == "confirmed").alias("yes"), "reviewed_at")
    rows = rows.where("a <> b").select(
        F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"), F.coalesce("yes", F.lit(False)).alias("yes"), "reviewed_at"
    )
    latest = F.max(F.struct(F.col("reviewed_at"), ~F.col("yes")))
    return rows.groupBy("u", "v").agg(latest.alias("last")).where(~F.col("last.col2")).select("u", "v")


def group_units(links: DataFrame) -> DataFrame:
    """Columns ``grp, related`` for the groups that confirmed links join; all others relate to themselves only."""
    return connected_components(confirmed_links(links)).toDF("grp", "related")


def _records(manifest: DataFrame) -> DataFrame:
    return manifest.where(is_included(F.col("split_status"))).select(
        F.col("canonical_id").alias("id"),
        id_key(F.col("canonical_id")).alias("record"),
        group_key(F.col("source_dataset"), F.col("source_group")).alias("grp"),
        split_key(F.col("avax_split")).alias("split"),
        (F.lower(trimmed(F.col("real_synthetic"))) == "synthetic").alias("synthetic"),
        F.col("is_negative").alias("negative"),
    )


def placed_rows(manifest: DataFrame, links: DataFrame) -> DataFrame:
    """The distinct included rows with ``related`` (their group, or the groups that links join to it) and ``unit``; written.

    A unit is what may not be torn: related rows, and all rows of a record, so a record
    that names several groups ties them together. A row without a group has a null
    ``related`` and shares the unit of its record, else it is a unit of its own. ``n``
    counts equal rows.
    """
    rows = _records(manifest)
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(group_units(links), "grp", "left").withColumn("related", F.coalesce("related", "grp"))
    rows = materialize(rows, "related")
    named = rows.where("record is not null and related is not null").select("record", "related")
    several = named.groupBy("record").agg(F.min("related").alias("u"), F.max("related").alias("v")).where("u <> v").select("record", "u")
    ties = materialize(named.join(several, "record").where("related <> u").select("u", F.col("related").alias("v")).distinct(), "ties")
    if ties.isEmpty():
        rows = rows.withColumn("unit", F.col("related"))
    else:
        rows = rows.join(connected_components(ties).toDF("related", "unit"), "related", "left").withColumn("unit", F.coalesce("unit", "related"))
    own = named.groupBy("record").agg(F.min("related").alias("first")).select("record", "first")
    # rows without a group take the unit of a group that their record names elsewhere
    lone = rows.where("related is null").drop("unit").join(own, "record", "left").withColumnRenamed("first", "__at")
    lone = lone.join(rows.where("related is not null").select(F.col("related").alias("__at"), "unit").distinct(), "__at", "left").drop("__at")
    lone = lone.withColumn("unit", F.coalesce("unit", F.concat(F.lit("id|"), F.col("record"))))
    cols = ["id", "record", "grp", "split", "synthetic", "negative", "n", "related", "unit"]
    return materialize(rows.where("related is not null").select(*cols).unionByName(lone.select(*cols)), "placed")


def _torn(placed: DataFrame) -> DataFrame:
    """Sets of related rows that stand in more than one split: ``related, groups`` and the rows in each split."""
    by = placed.where("related is not null").groupBy("related", "grp").agg(*(F.coalesce(F.sum(F.when(F.col("split") == s, F.col("n"))), F.lit(0)).alias(s) for s in SPLITS))
    sets = by.groupBy("related").agg(F.count(F.lit(1)).alias("groups"), *(F.sum(s).alias(s) for s in SPLITS))
    return sets.where(sum((F.col(s) > 0).cast("int") for s in SPLITS) > 1)


def torn_relations(placed: DataFrame) -> DataFrame:
    """The relations that the present split tears apart: ``unit, groups, train_rows, val_rows, test_rows``.

    Takes ``placed_rows`` or ``assignment``. Only rows with a group count; a split that is
    none of the three is none. Empty tables give an empty result.
    """
    return _torn(placed).select(F.col("related").alias("unit"), "groups", *(F.col(s).cast("long").alias(f"{s}_rows") for s in SPLITS))


def torn_records(placed: DataFrame) -> DataFrame:
    """Each distinct ``canonical_id`` whose related records stand in more than one split; input as for ``torn_relations``.

    Ids count as they stand; a null id is no case.
    """
    rows = placed.where("related is not null and id is not null").select("id", "related")
    return rows.join(_torn(placed).select("related"), "related", "left_semi").select(F.col("id").alias("canonical_id")).distinct()


class Flow:
    """Min-cost flow by shortest distances and blocking flows along them; costs are whole numbers of 0 or more."""

    def __init__(self) -> None:
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []
        self.out: dict[object, list[int]] = {}
        self.number: dict[object, int] = {}

    def node(self, name: object) -> int:
        return self.number.setdefault(name, len(self.number))

    def edge(self, a: object, b: object, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out.setdefault(self.node(x), []).append(len(self.to))
            self.to.append(self.node(y))
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def distances(self, source: int) -> list[float]:
        far = [float("inf")] * len(self.number)
        far[source] = 0
        queue, waiting = deque([source]), {source}
        while queue:
            x = queue.popleft()
            waiting.discard(x)
            for e in self.out.get(x, ()):
                y = self.to[e]
                if self.room[e] > 0 and far[x] + self.cost[e] < far[y]:
                    far[y] = far[x] + self.cost[e]
                    if y not in waiting:
                        waiting.add(y)
                        queue.append(y)
        return far

    def run(self, source: object, sink: object) -> int:
        s, t, total = self.node(source), self.node(sink), 0
        while (far := self.distances(s))[t] < float("inf"):
            at = {x: 0 for x in self.out}
            path, on = [], {s}
            x = s
            while True:
                if x == t:
                    push = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= push
                        self.room[e ^ 1] += push
                    total += push
                    path, on, x = [], {s}, s
                    continue
                edges = self.out.get(x, [])
                while at[x] < len(edges):
                    e = edges[at[x]]
                    y = self.to[e]
                    if self.room[e] > 0 and y not in on and far[y] == far[x] + self.cost[e]:
                        break
                    at[x] += 1
                if at[x] < len(edges):
                    path.append(edges[at[x]])
                    x = self.to[edges[at[x]]]
                    on.add(x)
                elif x == s:
                    break
                else:
                    on.discard(x)
                    x = self.to[path.pop() ^ 1]
                    at[x] += 1
        return total

    def used(self, e: int) -> int:
        return self.room[e ^ 1]


def _parts(n: int, shares: dict[str, float]) -> dict[str, int]:
    """``n`` cut in proportion to the shares, by largest remainders."""
    weight = sum(shares.values())
    exact = {k: n * x / weight for k, x in shares.items()}
    out = {k: int(x) for k, x in exact.items()}
    for k in sorted(shares, key=lambda k: (out[k] - exact[k], k))[: n - sum(out.values())]:
        out[k] += 1
    return out


def _flow(bundles: dict[int, tuple[int, str, int]], room: dict[object, int], shares: dict[str, float], costs: tuple[int, int, int]) -> dict[int, dict[str, int]]:
    """Records of each bundle for each split, where ``room`` has what is left of each quota."""
    net, total = Flow(), sum(s * n for s, _, n in bundles.values())
    own, of_label, of_split = costs
    arcs = {}
    for i, (size, lab, n) in bundles.items():
        net.edge("source", i, size * n, 0)
        near = _parts(size * n, shares)
        arcs[i] = {k: (net.edge(i, (lab, k), near[k], 0), net.edge(i, (lab, k), size * n, own)) for k in shares}
    for lab in {lab for _, lab, _ in bundles.values()}:
        for k in shares:
            net.edge((lab, k), ("split", k), max(0, room[lab, k]), 0)
            net.edge((lab, k), ("split", k), total, of_label)
    for k in shares:
        net.edge(("split", k), "sink", max(0, room[k]), 0)
        net.edge(("split", k), "sink", total, of_split)
    net.run("source", "sink")
    return {i: {k: sum(map(net.used, e)) for k, e in a.items()} for i, a in arcs.items()}


def solve_quotas(bundles: list[tuple[int, str, int]], shares: dict[str, float], costs: tuple[int, int, int] = (1, 2, 16)) -> list[dict[str, int]]:
    """For each bundle (size, label, units) the whole number of units for each split.

    The flow is in records; ``costs`` are those of a record beyond the proportional
    part of its bundle, of its label in a split, and of a split. The largest sizes are
    rounded to whole units first, an octave at a time; the flow of the rest is then
    solved again with what is left of the quotas, so small units make good what large
    ones round away.
    """
    room: dict[object, int] = dict(_parts(sum(s * n for s, _, n in bundles), shares))
    for lab in {lab for _, lab, _ in bundles}:
        room |= {(lab, k): q for k, q in _parts(sum(s * n for s, x, n in bundles if x == lab), shares).items()}
    rest = {i: b for i, b in enumerate(bundles) if b[2] > 0}
    out: list[dict[str, int]] = [dict.fromkeys(shares, 0) for _ in bundles]
    while rest:
        flow = _flow(rest, room, shares, costs)
        octave = max(s for s, _, _ in rest.values()).bit_length()
        for i in sorted((i for i, b in rest.items() if b[0].bit_length() == octave), key=lambda i: (-bundles[i][0], bundles[i][1])):
            size, lab, n = rest.pop(i)
            give = {k: flow[i][k] // size for k in shares}
            part = {k: flow[i][k] - give[k] * size for k in shares}
            for k in shares:
                room[k] -= give[k] * size
                room[lab, k] -= give[k] * size
            for _ in range(n - sum(give.values())):
                k = max(shares, key=lambda k: (min(0, room[k] - size) * 4 + min(0, room[lab, k] - size) + part[k], k))
                give[k] += 1
                part[k] -= size
                room[k] -= size
                room[lab, k] -= size
            out[i] = give
    return out


def assignment(manifest: DataFrame, links: DataFrame, targets: DataFrame, seed: str = "split") -> DataFrame:
    """``placed_rows`` with ``unit_records`` and ``assigned_split``; rows without an id have no split.

    Needs the manifest's ``canonical_id, source_dataset, source_group, avax_split,
    split_status, real_synthetic, is_negative``, the links' six columns and
    ``targets(split_name, target_share)``; further columns are ignored. Ids that differ
    only in case, blanks or an image extension count as one record. The label profile of
    a unit is whether most of its records are negative and whether most are synthetic.

    The driver gets one line for each bundle of equal size and profile. The sizes of all
    units add up to the number of records, so n records have fewer than sqrt(2 n)
    different sizes in each of the four profiles.
    Units are ranked within bundles by a distributed sort, not by a window.
    """
    placed = placed_rows(manifest, links)
    records = placed.where("record is not null").groupBy("unit", "record").agg(F.max("negative").alias("negative"), F.max("synthetic").alias("synthetic"))
    half = lambda c: (F.count_if(F.col(c)) * 2 > F.count(F.lit(1))).cast("int").cast("string")
    units = records.groupBy("unit").agg(F.count(F.lit(1)).alias("size"), F.concat(half("negative"), half("synthetic")).alias("label"))
    units = units.withColumn("key", F.sha2(F.concat(F.lit(seed), F.col("unit")), 256))
    ranked = global_positions(units, ["size", "label", "key", "unit"], "place")
    bundles = ranked.groupBy("size", "label").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("start")).orderBy("size", "label").collect()
    shares = {r[0]: r[1] for r in targets.select("split_name", "target_share").where("split_name is not null and target_share > 0").collect()}
    given = solve_quotas([(b["size"], b["label"], b["n"]) for b in bundles], shares)
    lines, names = [], list(shares)
    for b, g in zip(bundles, given):
        at = b["start"]
        for k in names:
            if g[k]:
                lines.append((b["size"], b["label"], at, at + g[k], k))
                at += g[k]
    plan = manifest.sparkSession.createDataFrame(lines, "size long, label string, low long, high long, assigned_split string")
    ranges = F.broadcast(plan)  # one line for each bundle and split
    done = ranked.join(ranges, (ranked["size"] == plan["size"]) & (ranked["label"] == plan["label"]) & (F.col("place") >= F.col("low")) & (F.col("place") < F.col("high")))
    return materialize(placed.join(done.select("unit", ranked["size"].alias("unit_records"), "assigned_split"), "unit", "left"), "assigned")


def assign_splits(manifest: DataFrame, links: DataFrame, targets: DataFrame, seed: str = "split") -> DataFrame:
    """Columns ``canonical_id, record_key, unit, unit_records, assigned_split, present_split``, one row for each distinct canonical_id of the included rows.

    Inputs as for ``assignment``. A null or blank id is left out. An id that stands in
    several splits shows the first of them by name.
    """
    rows = assignment(manifest, links, targets, seed).where("record is not null")
    first = {"record": "record_key", "unit": "unit", "unit_records": "unit_records", "assigned_split": "assigned_split", "split": "present_split"}
    return rows.groupBy(F.col("id").alias("canonical_id")).agg(*(F.min(c).alias(n) for c, n in first.items()))


def split_invariants(assigned: DataFrame, targets: DataFrame) -> DataFrame:
    """What must hold of ``assignment``, one row a target: ``split_name, target_share, records, torn_units, torn_related``.

    ``records`` of the split, and the units and related sets of all rows that stand in
    more than one assigned split.
    """
    rows = assigned.where("record is not null")
    several = lambda c, n: rows.where(F.col(c).isNotNull()).groupBy(c).agg(F.count_distinct("assigned_split").alias("k")).agg(F.count_if(F.col("k") > 1).alias(n))
    records = rows.groupBy("record").agg(F.min("assigned_split").alias("split_name")).groupBy("split_name").agg(F.count(F.lit(1)).alias("records"))
    out = targets.select("split_name", "target_share").join(records, "split_name", "left").withColumn("records", F.coalesce("records", F.lit(0)))
    return out.crossJoin(F.broadcast(several("unit", "torn_units"))).crossJoin(F.broadcast(several("related", "torn_related")))  # one row each


def split_report(assigned: DataFrame, targets: DataFrame) -> DataFrame:
    """``split_name, target_share, records, share, units`` of an assignment; ids of one record count once."""
    records = assigned.groupBy("record_key").agg(F.min("assigned_split").alias("split_name"), F.min("unit").alias("unit"))
    by = records.groupBy("split_name", "unit").count().groupBy("split_name").agg(F.sum("count").alias("records"), F.count(F.lit(1)).alias("units"))
    total = by.agg(F.sum("records").alias("all_records"))
    return (
        targets.select("split_name", "target_share")
        .join(by, "split_name", "left")
        .crossJoin(F.broadcast(total))  # one row
        .select("split_name", "target_share", F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("units", F.lit(0)).alias("units"), F.round(F.coalesce(F.try_divide("records", "all_records"), F.lit(0.0)), 6).alias("share"))
    )
