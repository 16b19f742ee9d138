import hashlib
import random

import pytest
from pyspark.sql import functions as F

from curatrix.operators import audit, dedup, joins, review, selection, sets
from curatrix.operators.components import connected_components
from curatrix.operators.near import band_masks, hamming_join, near_within
from curatrix.operators.ranks import global_positions


def test_positions_with_ties_nulls_and_weights(spark):
    r = random.Random(3)
    rows = [(i, r.choice([None, 1, 1, 2, 5]), r.randint(1, 4)) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, v int, position int").repartition(7)
    want = sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[0]))
    got = {r["i"]: r["position"] for r in global_positions(df, ["v", "i"]).collect()}
    assert [got[i] for i, _, _ in want] == list(range(500))
    df = df.withColumnRenamed("position", "n")
    got = {r["i"]: r["before"] for r in global_positions(df, ["v", "i"], "before", "n").collect()}
    at = 0
    for i, _, n in want:
        assert got[i] == at
        at += n
    assert global_positions(df.where("false"), ["v", "i"]).count() == 0


def test_components_against_union_find(spark):
    r = random.Random(5)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(500 + i, 501 + i) for i in range(60)] + [(900, 900 + i) for i in range(1, 40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    df = spark.createDataFrame([*edges, (None, 3), (7, 7)], "a long, b long")
    got = {x["node"]: x["component"] for x in connected_components(df, "a", "b").collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert connected_components(df.where("false"), "a", "b").count() == 0


@pytest.mark.parametrize("bands,crowded", [(None, 4_000_000), (3, 4_000_000), (9, 5), (3, 60)])
def test_hamming_join_against_brute_force(spark, bands, crowded):
    r = random.Random(7)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = [(r.getrandbits(64), r.getrandbits(64)) for _ in range(40)]
    flip = lambda x, n: x ^ sum(1 << b for b in r.sample(range(64), n))
    left = base + [(0, r.getrandbits(64)) for _ in range(30)]
    right = [(flip(p, r.randint(0, 10)), flip(d, r.randint(0, 12))) for p, d in base for _ in range(3)] + [(0, flip(d, 3)) for _, d in left[-30:]]
    dfs = [spark.createDataFrame([(signed(a), signed(b)) for a, b in rows] * 2 + [(None, 1)], "p long, d long") for rows in (left, right)]
    got = {tuple(x) for x in hamming_join(*dfs, "p", 8, "d", 10, crowded=crowded, bands=bands).collect()}
    rows = hamming_join(*dfs, "p", 8, "d", 10, crowded=crowded, bands=bands).count()
    want = {(signed(a), signed(b), signed(c), signed(d)) for a, b in left for c, d in right if (a ^ c).bit_count() <= 8 and (b ^ d).bit_count() <= 10}
    named = {(x, y, z, w) for x, y, z, w in got}
    assert rows == len(named)
    assert {tuple(sorted(x)) for x in named} == {tuple(sorted(x)) for x in want}
    assert sum(m.bit_count() for m in band_masks(5)) == 64


def test_exact_groups(spark):
    df = spark.createDataFrame([("h1", "a", 9), ("h1", "b", 9), ("h2", "a", 9), (None, "a", 9), (None, "b", 9), ("h3", None, 9), ("h3", None, 9)], "h string, g string, members int")
    got = {(r["h"], r["members"], r["crosses_groups"]) for r in dedup.exact_groups(df, "h", "g").collect()}
    assert got == {("h1", 2, True), ("h3", 2, False)}
    assert dedup.exact_groups(df.where("false"), "h", "g").count() == 0


def test_joins(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    right = spark.createDataFrame([(1, "one", "q"), (2, None, "q")], "k int, name string, v string")
    out = joins.checked_left_join(left, right, ["k"])
    assert out.columns == ["k", "v", "name"] and out.count() == 3
    with pytest.raises(ValueError, match="missing values"):
        joins.checked_left_join(left, right, ["k"], required=["name"])
    with pytest.raises(ValueError, match="repeated keys"):
        joins.checked_left_join(left, right.union(right), ["k"])
    assert joins.anti(left, "k", right.where("k = 1")).count() == 2
    assert {r["name"] for r in joins.lookup(left, right, "k", "name").collect()} == {"one", "UNKNOWN_2", "UNKNOWN_"}
    files = spark.createDataFrame([("b/1.png",)], "path string")
    options = spark.createDataFrame([(1, "a/1.png", 0), (1, "b/1.png", 1), (2, "b/2.png", 0)], "k int, path string, p int")
    assert {tuple(r) for r in joins.first_existing(options, files, "k", "path", "p").collect()} == {(1, "b/1.png"), (2, None)}
    order = spark.createDataFrame([(2, 1), (1, 2)], "k int, position int")
    assert [r["k"] for r in joins.in_order_of(left.where("k is not null"), order, "k", "position").collect()] == [2, 1]


def test_pairing_states(spark):
    a, b = (spark.createDataFrame([(x,) for x in v], "k string") for v in (["a", "a", "b", None], ["b", "c"]))
    assert {tuple(r) for r in audit.pairing(a, b, "k").collect()} == {("a", "missing"), ("b", "paired"), ("c", "orphan")}
    assert {tuple(r) for r in sets.symmetric_difference(a, b, "k").collect()} == {("a", "left"), ("c", "right")}


@pytest.mark.parametrize("n,val", [(5, 0), (15, 2), (25, 2), (504, 50), (5368, 537)])
def test_split_sizes(spark, n, val):
    df = spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit("s").alias("g"), F.lit("old").alias("split"))
    got = {r["split"]: r["count"] for r in selection.hash_split(df, "k", "g").groupBy("split").count().collect()}
    assert got.get("val", 0) == val and got.get("test", 0) == val and got["train"] == n - 2 * val
    if n == 25:
        ranked = selection.rank_in_group(df.union(df.withColumn("g", F.lit(None))), "g", ["k"], most=3)
        assert sorted(r["rank"] for r in ranked.collect()) == sorted([*range(1, 26)] * 2)


@pytest.mark.parametrize("most", [100_000, 9])
def test_split_of_large_groups(spark, most):
    rows = [(i, str(i), g) for g, n in (("a", 4001), ("b", 127), ("c", 3), (None, 65)) for i in range(n)]
    df = spark.createDataFrame(rows, "i int, k string, g string").repartition(5)
    want = {}
    for group in ("a", "b", "c", None):
        order = sorted((k for _, k, g in rows if g == group), key=lambda k: hashlib.sha256(f"{k}|".encode()).hexdigest())
        n = round(len(order) * 0.1)
        want |= {(k, group): "val" if at < n else "test" if at < 2 * n else "train" for at, k in enumerate(order)}
    out = selection.hash_split(df, "k", "g", most=most)
    assert sorted(out.columns) == ["g", "i", "k", "split"]
    got = [((r["k"], r["g"]), r["split"]) for r in out.collect()]
    assert len(got) == len(rows) and dict(got) == want


def test_composition_of_a_split_of_large_groups(spark, tmp_path):
    from curatrix.plans import queries

    n = {"A": 1_100_005, "B": 25, "C": 4}  # a group above a million rows, rounding half to even, no rows for val
    ends = [n["A"], n["A"] + n["B"]]
    name = F.when(F.col("id") < ends[0], "A").when(F.col("id") < ends[1], "B").otherwise("C")
    spark.range(sum(n.values())).select(F.col("id").alias("o_orderkey"), name.alias("o_orderpriority"), F.lit("O").alias("o_orderstatus")).write.parquet(f"{tmp_path}/orders.parquet")
    got = {(r["o_orderpriority"], r["split"]): r["row_count"] for r in queries()["split_composition"](spark, str(tmp_path)).collect()}
    assert got == {("A", "val"): 110_000, ("A", "test"): 110_000, ("A", "train"): 880_005, ("B", "val"): 2, ("B", "test"): 2, ("B", "train"): 21, ("C", "train"): 4}


@pytest.mark.parametrize("most", [1_000_000, 9])
def test_ranks_beside_a_hash_column(spark, most):
    df = spark.range(40).select("id", (F.col("id") % 3).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("__h"))
    ranks = {r["id"]: r["rank"] for r in selection.rank_in_group(df, "g", ["__h"], most=most).collect()}
    order = sorted(range(40), key=lambda i: (i % 3, hashlib.sha256(str(i).encode()).hexdigest()))
    assert [ranks[i] for i in order] == [*range(1, 15), *range(1, 14), *range(1, 14)]


@pytest.mark.parametrize("most", [1_000_000, 3])
def test_first_of_repeated_keys(spark, most):
    df = spark.range(900).select((F.col("id") % 7).cast("string").alias("k"), F.sha2((F.col("id") % 7).cast("string"), 256).alias("h"), F.lit("x").alias("g"))
    for cap in (0, 1, 200, 899, 900, 5000):
        assert selection.keep_first(df, "k", cap).where("kept").count() == min(cap, 900)
        kept = selection.rank_class(df, "g", ["h", "k"], [F.lit(cap)], most=most).where("class = 0")
        assert kept.count() == min(cap, 900)
    order = sorted(range(7), key=lambda i: hashlib.sha256(f"{i}|s".encode()).hexdigest())
    assert {int(r["k"]) for r in selection.keep_first(df, "k", 250, "s").where("kept").collect()} == set(order[:2])


def test_cap_and_quota(spark):
    df = spark.range(8003).select(F.col("id").cast("string").alias("k"), (F.col("id") >= 5717).alias("s"))
    out = selection.synthetic_cap(df, "k", F.col("s"), F.lit(True))
    assert out.where("exclusion_reason is not null").count() == 8003 - 5717 - 1905
    assert out.where("s and exclusion_reason is null").count() == 1905
    rows = spark.createDataFrame([(f"i{n}", c) for n in range(10) for c in ("a", "b")] + [("z", "b")], "id string, c string")
    got = selection.quota_sample(rows, "id", "c", {"a": 8, "b": 8})
    taken = got.collect()
    assert len({r["id"] for r in taken}) == len(taken)
    short = {r["c"]: r["shortfall"] for r in selection.quota_shortfall(got, "c", {"a": 8, "b": 8}).collect()}
    assert short == {"a": 0, "b": 5}
    with pytest.raises(Exception, match="no split for group"):
        selection.mapped_split(df, "k", {"0": "val"}).collect()


def test_review_state(spark):
    variants = spark.createDataFrame([("g1", 1, ""), ("g2", 1, ""), ("g2", 2, None), ("g3", 1, "keep")], "g string, i int, status string")
    groups = spark.createDataFrame([("g1", "ok"), ("g2", "ok"), ("g3", "drop"), ("g4", "unsure")], "g string, status string")
    got = {(r["g"], r["i"]): r["status"] for r in review.migrate_group_decisions(variants, groups, "g", "status").collect()}
    assert got == {("g1", 1): "ok", ("g2", 1): "", ("g2", 2): "", ("g3", 1): "keep"}
    log = spark.createDataFrame([("a", "x", 1, 1), ("a", "y", 2, 1), ("b", "p", 1, 1), ("b", "q", 1, 2), (None, "x", 1, 1)], "k string, s string, at int, tie int")
    assert {(r["k"], r["s"]) for r in review.latest_decisions(log, "k", "s", "at", "tie").collect()} == {("a", "y"), ("b", "q")}
    pairs = spark.createDataFrame([("g", "a", "b", "a")], "g string, x string, y string, keep string")
    assert review.adjudicate(pairs, "g", "x", "y", "keep").first()["exclude_id"] == "b"
    with pytest.raises(ValueError, match="unresolved"):
        review.adjudicate(pairs.withColumn("keep", F.lit("")), "g", "x", "y", "keep")
    clash = pairs.union(spark.createDataFrame([("h", "a", "c", "c")], pairs.schema))
    with pytest.raises(ValueError, match="kept and excluded"):
        review.adjudicate(clash, "g", "x", "y", "keep")
    events = spark.createDataFrame([(i, i % 2 == 0) for i in range(20)], "at int, yes boolean")
    assert review.until_target(events, ["at"], F.col("yes"), 3).count() == 5
    assert review.until_target(events, ["at"], F.col("yes"), 99).count() == 20
    flags = review.flag_repeats(spark.createDataFrame([("a", 2), ("a", 1), ("b", 1), (None, 1)], "k string, o int"), "k", ["o"])
    assert {(r["k"], r["o"], r["repeat"], r["repeated"]) for r in flags.collect()} == {("a", 2, True, True), ("a", 1, False, True), ("b", 1, False, False), (None, 1, False, False)}


def test_audits_on_empty_tables(spark):
    empty = spark.createDataFrame([], "k string, v int")
    assert tuple(audit.totals(empty, {"f": F.col("v") > 0}, {"s": F.col("v")}).first()) == (0, 0, 0)
    assert audit.completeness(empty, "k", "v").count() == 2
    assert audit.share_of(empty, F.col("v") > 0).first()[0] == 0.0
    for df in (audit.distribution(empty, "k"), audit.spanning_keys(empty, "k", "v"), audit.count_of_counts(empty, "k"), audit.agreement(empty, "k", "v"), audit.evenly_spaced(empty, "k", 3)):
        assert df.count() == 0
    assert [r["id"] for r in audit.evenly_spaced(spark.range(101), "id", 5).orderBy("id").collect()] == [0, 25, 50, 75, 100]


def test_stage_tables_are_removed(spark):
    import os

    from curatrix import session

    with session.stage_tables(spark):
        df = session.materialize(spark.range(3), "scoped")
        place = os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
        assert df.count() == 3 and os.path.isdir(place)
    assert not os.path.exists(place)


@pytest.mark.parametrize("crowded", [4_000_000, 4])
def test_hamming_join_of_one_hash_with_itself(spark, crowded):
    r = random.Random(12)
    base = [r.getrandbits(62) for _ in range(60)] + [r.getrandbits(8) for _ in range(40)]  # forty that share most bits
    rows = base + [x ^ (1 << r.randrange(62)) ^ (1 << r.randrange(62)) for x in base]
    df = spark.createDataFrame([(x,) for x in rows + rows[:9]] + [(None,)], "h long")
    got = [tuple(x) for x in hamming_join(df, df, "h", 3, crowded=crowded, bands=4, halve=True).collect()]
    values = sorted(set(rows))
    want = {(a, b) for a in values for b in values if a <= b and (a ^ b).bit_count() <= 3}
    assert len(got) == len(set(got)) and set(got) == want
    assert hamming_join(df.where("false"), df, "h", 3).count() == 0


@pytest.mark.parametrize("bands,crowded,most", [(None, 4_000_000, 1_000_000), (9, 30, 40), (10, 4_000_000, 40), (11, 30, 1_000_000)])
def test_near_within_against_brute_force(spark, bands, crowded, most):
    r = random.Random(17)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    flip = lambda x, n: x ^ sum(1 << b for b in r.sample(range(64), n))
    base = [(r.getrandbits(64), r.getrandbits(64)) for _ in range(60)]
    base += [(p, r.getrandbits(64)) for p in (0, 1 << 63) for _ in range(25)]  # two near values that many rows share
    rows = base + [(flip(p, r.randint(0, 10)), flip(d, r.randint(0, 12))) for p, d in base for _ in range(3)] + [(p, flip(d, r.randint(1, 12))) for p, d in base]
    df = spark.createDataFrame([(signed(p), signed(d)) for p, d in rows + rows[:9]] + [(None, 1), (1, None)], "p long, d long")
    got = [tuple(x) for x in near_within(df, "p", 8, "d", 10, crowded, bands, most).collect()]
    values = sorted({(signed(p), signed(d)) for p, d in rows})
    bits = lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count()
    want = {x + y for x in values for y in values if x < y and bits(x[0], y[0]) <= 8 and bits(x[1], y[1]) <= 10}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100
    assert near_within(df.where("false"), "p", 8, "d", 10).count() == 0


def test_near_values_are_copied_little(spark):
    from curatrix.operators import near

    for rows in (10**4, 10**6, 3 * 10**6, 10**8):
        assert 9 <= near._equal_bands(8, rows) <= 13
    values = spark.range(50).select(F.xxhash64("id").alias("v"))
    plan = near._near_values(values, 8)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("shiftrightunsigned") == 9  # nine copies of a value; probes of every change were 696 at three million


def test_policy_makes_no_probes_of_rare_values(spark, monkeypatch):
    from curatrix.operators import near
    from curatrix.plans import queries

    def none(*_):
        raise AssertionError("probes of every change")

    monkeypatch.setattr(near, "_spread", none)
    assert queries()["split_policy_violations"](spark, "/root/testdata/sf0.001").count() == 6
