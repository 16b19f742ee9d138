import random

import pytest
from pyspark.sql import functions as F

from curatrix.llm import sample, split

MANIFEST = "canonical_id string, source_dataset string, source_group string, avax_split string, split_status string, real_synthetic string, is_negative boolean, manifest_version int, unit string, record_key string"
LINKS = "source_dataset_a string, source_group_a string, source_dataset_b string, source_group_b string, link_status string, reviewed_at timestamp"


def manifest(spark, rows):
    """(id, dataset, group, split, status, version); two columns with clashing names are added."""
    full = [(i, d, g, s, st, "REAL", False, v, "clash", "clash") for i, d, g, s, st, v in rows]
    return spark.createDataFrame(full, MANIFEST)


def test_feistel_is_a_permutation_and_matches_python(spark):
    numbers = [random.Random(1).getrandbits(64) for _ in range(200)] + [0, 1, 2**64 - 1, 2**63]
    signed = [(n - (1 << 64) if n >> 63 else n,) for n in numbers]
    out = spark.createDataFrame(signed, "n long").select(sample.feistel(F.col("n"), F.lit(99).cast("long"), 7).alias("m")).collect()
    assert [r["m"] % (1 << 64) for r in out] == [sample.feistel_int(n, 99, 7) for n in numbers]
    small = {sample.feistel_int(n, 5, 7) for n in range(20000)}
    assert len(small) == 20000
    assert 0.08 < sum(x < 2**64 // 10 for x in small) / 20000 < 0.12


def test_sample_is_stable(spark):
    r = random.Random(2)
    rows = [(f"kaggle__{r.getrandbits(64):016x}", "kaggle", f"g{i % 50}", "train", "included", i % 3 + 1) for i in range(3000)]
    rows += [(x[0].upper(), *x[1:5], 3) for x in rows[:300]] + [(x[0] + ".jpg", *x[1:5], 3) for x in rows[:300]]
    rows += [(None, "kaggle", "g", "train", "included", 1), ("  ", "kaggle", "g", "train", "included", 1), ("odd id", None, None, None, None, None)]
    df = manifest(spark, rows)
    got = sample.stable_sample(df, 0.2)
    keys = {x["record_key"] for x in got.collect()}
    assert 480 < len(keys) < 720 and got.count() == len(keys)
    assert keys == {x["record_key"] for x in sample.stable_sample(df.repartition(13, "source_group"), 0.2).collect()}
    early = {x["record_key"] for x in sample.stable_sample(df.where("manifest_version <= 2"), 0.2).collect()}
    assert early <= keys
    assert [x["lost_records"] for x in sample.growth_report(df, 0.2).collect()] == [0, 0, 0]
    assert sample.stable_sample(df, 0.0).count() == 0
    assert sample.stable_sample(df, 1.0).count() == 3001
    assert sample.stable_sample(df.where("false"), 0.5).count() == 0
    groups = {}
    for x in sample.stable_sample(df, 0.3, unit="group").collect():
        groups.setdefault(x["unit_key"], 0)
        groups[x["unit_key"]] += 1
    assert all(n == 60 for g, n in groups.items() if g.startswith("kaggle|"))
    with pytest.raises(ValueError):
        sample.stable_sample(df, 1.5)


def test_spellings_of_groups(spark):
    rows = [("Open_Images V7 ", "raw\\Cam1_jpg.rf.0af.jpg"), ("open-images-v7", " cam1_jpg"), ("openimagesv7", "export/v2/cam1_jpg#t=12.jpg"), ("a", "n/a"), ("a", " - "), ("a", None), (None, "g"), ("a", "x/unknown"), ("a", "")]
    df = spark.createDataFrame(rows, "d string, g string")
    got = [r[0] for r in df.select(split.group_key(F.col("d"), F.col("g"))).collect()]
    assert got[:3] == ["openimagesv7|cam1_jpg"] * 3
    assert got[3:] == [None] * 6


@pytest.mark.parametrize("tweak", [0, 1, 2, 255, (1 << 28) - 1])
def test_sequential_numbers_are_spread_evenly(tweak):
    """Numbers in a row fill all sixteenths of the domain alike, and the draws of neighbouring tweaks and seeds are independent."""
    n, rate = 8000, 0.1
    got = [sample.feistel_int(k, tweak, 7) for k in range(n)]
    assert len(set(got)) == n
    cells = [0] * 16
    for x in got:
        cells[x >> 60] += 1
    assert sum((c - n / 16) ** 2 / (n / 16) for c in cells) < 37.7  # chi-square, 15 degrees, 0.001
    limit = int(rate * 2**64)
    drawn = {k for k, x in enumerate(got) if x < limit}
    assert abs(len(drawn) - n * rate) < 4 * (n * rate * (1 - rate)) ** 0.5
    for other in ({k for k in range(n) if sample.feistel_int(k, tweak ^ 1, 7) < limit}, {k for k in range(n) if sample.feistel_int(k, tweak, 8) < limit}):
        assert abs(len(drawn & other) - n * rate**2) < 4 * (n * rate**2) ** 0.5


def test_found_and_torn(spark):
    import datetime as dt

    t = lambda d: dt.datetime(2024, 1, d)
    m = manifest(spark, [
        ("a1", "d", "g1", "train", "included", 1), ("a2", "D ", "G1", " Test", "included", 1),  # torn by itself
        ("b1", "d", "g2", "train", "included", 1), ("c1", "d", "g3", "validation", "included", 1),  # torn by a link
        ("e1", "d", "g4", "train", "included", 1), ("f1", "d", "g5", "val", "included", 1),  # link later rejected
        ("h1", "d", "unknown", "train", "included", 1), ("h2", "d", "unknown", "val", "included", 1),
        ("i1", "d", "g6", "train", "included", 1), ("i2", "d", "g6", "val", "excluded", 1),
        ("j1", "d", "g7", None, "included", 1), (None, "d", "g1", "train", "included", 1), ("a1", "d", "g1", "train", "included", 2),
    ])
    links = spark.createDataFrame([
        ("d", "raw/g2", "d", "x", "Confirmed ", t(1)), ("d", "x", "d", "g3", "confirmed", t(1)), ("d", "g7", "d", "x", "confirmed", t(1)),
        ("d", "g4", "d", "g5", "confirmed", t(1)), ("d", "g5", "d", "g4", "rejected", t(2)), ("d", "g6", "d", "g6", "confirmed", t(1)), ("d", None, "d", "g1", "confirmed", t(1)),
    ], LINKS)
    assert {r[0] for r in split.torn_records(split.placed_rows(m, links)).collect()} == {"a1", "a2", "b1", "c1", "j1"}
    torn = {r["unit"]: (r["groups"], r["train_rows"], r["val_rows"], r["test_rows"]) for r in split.torn_relations(split.placed_rows(m, links)).collect()}
    assert torn == {"d|g1": (1, 3, 0, 1), "d|g2": (3, 1, 1, 0)}
    assert split.torn_records(split.placed_rows(m.where("false"), links.where("false"))).count() == 0


def test_assignment_keeps_units_and_shares(spark):
    r = random.Random(4)
    rows = [(f"k__{i:016x}", "d", f"g{min(int(r.paretovariate(0.9)), 900)}" if r.random() < 0.9 else None, "train", "included", 1) for i in range(4000)]
    rows += [(x[0].upper(), *x[1:]) for x in rows[:50]]
    m = manifest(spark, rows)
    links = spark.createDataFrame([("d", f"g{i}", "d", f"g{i + 1}", "confirmed", None) for i in range(400, 500)], LINKS)
    targets = spark.createDataFrame([("train", 0.8), ("val", 0.1), ("test", 0.1)], "split_name string, target_share double")
    out = split.materialize(split.assign_splits(m, links, targets))
    assert out.count() == 4050
    assert out.groupBy("unit").agg(F.count_distinct("assigned_split").alias("n")).where("n > 1").count() == 0
    report = {x["split_name"]: x for x in split.split_report(out, targets).collect()}
    assert sum(x["records"] for x in report.values()) == 4000
    largest = out.agg(F.max("unit_records")).first()[0]
    assert abs(report["val"]["share"] - 0.1) < max(0.01, largest / 4000 - 0.8)
    again = split.assign_splits(m.repartition(9), links, targets)
    assert again.exceptAll(out).count() == 0
    assert split.assign_splits(m.where("false"), links, targets).count() == 0


def test_groups_of_one_record_share_a_unit(spark):
    rows = [(f"{g}{i}", "d", g, "train", "included", 1) for g in ("ga", "gb", "gc", "gd") for i in range(3)]
    rows += [("twice", "d", "ga", "train", "included", 1), ("TWICE.jpg", "d", "gb", "train", "included", 2), ("twice", "d", "gc", "val", "included", 2), ("gd0", "d", "ga", "train", "excluded", 1), ("gd1", "d", "n/a", "train", "included", 1)]
    targets = spark.createDataFrame([("train", 0.5), ("val", 0.5)], "split_name string, target_share double")
    out = split.assign_splits(manifest(spark, rows), spark.createDataFrame([], LINKS), targets).collect()
    assert {x["record_key"]: (x["unit"], x["unit_records"]) for x in out} == {**{f"{g}{i}": ("d|ga", 10) for g in ("ga", "gb", "gc") for i in range(3)}, "twice": ("d|ga", 10), **{f"gd{i}": ("d|gd", 3) for i in range(3)}}
    assert len({x["assigned_split"] for x in out if x["unit"] == "d|ga"}) == 1


def test_large_units_count_with_their_own_size(spark):
    sizes = {"a": 5000, "b": 5150, "c": 4990, "d": 5160}  # a and c, b and d were once one bundle each, dealt by hash
    rows = spark.range(sum(sizes.values())).withColumn("n", F.col("id"))
    group, low = F.lit(None).cast("string"), 0
    for g, n in sizes.items():
        group, low = F.when((F.col("n") >= low) & (F.col("n") < low + n), g).otherwise(group), low + n
    rows = rows.select(F.format_string("k__%016x", "n").alias("canonical_id"), F.lit("d").alias("source_dataset"), group.alias("source_group"), F.lit("train").alias("avax_split"), F.lit("included").alias("split_status"), F.lit("real").alias("real_synthetic"), F.lit(False).alias("is_negative"))
    targets = spark.createDataFrame([("train", 0.5), ("val", 0.5)], "split_name string, target_share double")
    for seed in ("split", "s1", "s2", "s3"):
        report = split.split_report(split.materialize(split.assign_splits(rows, spark.createDataFrame([], LINKS), targets, seed=seed)), targets)
        assert {x["records"] for x in report.collect()} == {10150}


def test_flow_finds_the_least_cost():
    net = split.Flow()
    net.edge("s", "a", 4, 0)
    net.edge("s", "b", 4, 0)
    net.edge("a", "t", 3, 5)
    net.edge("a", "b", 4, 1)
    cheap = net.edge("b", "t", 6, 1)
    assert net.run("s", "t") == 8
    assert net.used(cheap) == 6


@pytest.mark.parametrize("bundles", [[], [(5000, "x", 1), (1, "x", 5000)], [(7, "x", 100), (3, "y", 100)], [(10**6, "x", 1)]])
def test_quotas_are_whole(bundles):
    shares = {"train": 0.8, "val": 0.1, "test": 0.1}
    out = split.solve_quotas(bundles, shares)
    assert [sum(g.values()) for g in out] == [n for _, _, n in bundles]
    total = sum(s * n for s, _, n in bundles)
    if len(bundles) > 1:
        for k, x in shares.items():
            got = sum(s * g[k] for (s, _, _), g in zip(bundles, out))
            assert abs(got - x * total) <= 7


def test_invariants_of_an_assignment(spark):
    targets = spark.createDataFrame([("train", 0.5), ("val", 0.5)], "split_name string, target_share double")
    m = manifest(spark, [("a", "d", "g1", "train", "included", 1), ("b", "d", "g1", "val", "included", 1), ("c", "d", "g2", None, "included", 1), ("  ", "d", "g3", "train", "included", 1)])
    none = spark.createDataFrame([], LINKS)
    out = split.assignment(m, none, targets)
    assert {(x["records"], x["torn_units"], x["torn_related"]) for x in split.split_invariants(out, targets).collect()} == {(2, 0, 0), (1, 0, 0)}
    torn = out.withColumn("assigned_split", F.when(F.col("id") == "a", "train").otherwise("val"))
    assert {(x["torn_units"], x["torn_related"]) for x in split.split_invariants(torn, targets).collect()} == {(1, 1)}
    empty = split.assignment(m.where("false"), none, targets)
    assert {(x["records"], x["torn_units"]) for x in split.split_invariants(empty, targets).collect()} == {(0, 0)}
