import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatrix.llm import overlap, quota

IMAGES = "ImageID string, NegativeBatch int, CandidateCategory string, MatchedClasses string, ReviewStatus string, batch string, profile string"
TARGETS = "negative_batch int, target_field string, target_value string, target_share double, min_count int, sample_size int"


def test_slips(spark):
    a = spark.createDataFrame([("roadgate",), ("roadgte",), ("roadgatee",), ("rodagte",), ("roaxgate",), (None,), ("",)], "s string")
    b = spark.createDataFrame([("roadgate",), ("yard",), (None,)], "k string")
    assert {r["spelling"] for r in quota.slip_map(a, b).collect()} == {"roadgate", "roadgte", "roadgatee", "roaxgate"}


def test_supply(spark):
    rows = [
        ("a1", 1, "Road Gate", "Car; Bus", "accepted_negative"), (" A1.jpg", 1, "yard", "car|CAR", "Accepted_Negative "), ("a2", 1, "road_gte", None, "accepted_negative"),
        ("a3", 1, "road_gate", "Car", "unsure"), ("a4", 2, "road_gate", "Car", "accepted_negative"), (None, 1, "road_gate", "Car", "accepted_negative"),
        ("a5", None, "road_gate", "Car", "accepted_negative"), ("a6", 1, None, "", "accepted_negative"), ("a7", 1, "yard", "Traffic  Sign,bus", "accepted_negative"),
    ]
    images = spark.createDataFrame([(*r, "x", "x") for r in rows], IMAGES)
    targets = spark.createDataFrame([(1, "CandidateCategory", "road_gate", 0.3, 1, 10), (1, "CandidateCategory", "yard", 0.1, 3, 10), (1, "MatchedClasses", "Car", 0.25, 1, 10), (1, "MatchedClasses", "Traffic sign", 0.1, 0, 10), (3, "MatchedClasses", "Car", 0.5, 1, 4)], TARGETS)
    got = {(r[0], r[2]): (r["ask"], r["supply"]) for r in quota.supply_report(images, targets).collect()}
    assert got == {(1, "road_gate"): (3, 2), (1, "yard"): (3, 2), (1, "Car"): (3, 1), (1, "Traffic sign"): (1, 1), (3, "Car"): (2, 0)}
    sample = quota.target_sample(images, targets)
    assert {r["image"] for r in sample.collect()} == {"a1", "a2", "a6", "a7"}
    empty = quota.target_sample(images.where("false"), targets)
    assert empty.count() == 0 and quota.sample_report(empty, images.where("false"), targets).where("can_be_met").count() == 0
    assert quota.supply_report(images, targets.where("false")).count() == 0


def test_rake_meets_margins():
    r = np.random.default_rng(0)
    carries = r.random((12, 4)) < 0.4
    counts = r.integers(1, 50, 12)
    start = counts @ carries / counts.sum()
    shares = np.clip(start * np.array([1.3, 0.7, 1.1, 0.9]), 0.05, 0.9)
    mass = quota.rake(counts, carries, shares, rounds=500, close=1e-7) * counts
    assert np.allclose(mass @ carries / mass.sum(), shares, atol=1e-3)


def test_rake_goes_on_by_default_until_the_shares_are_met():
    cells = [[4], [1, 7], [2, 6], [2, 8], [3], [0, 9], [], [0, 4], [3, 5], [1], [0], [2]]  # the worst gap rises in the second round of proportional fitting
    counts = np.array([12, 3, 2, 6, 2, 4, 2, 2, 5, 2, 1, 4])
    shares = np.array([0.128205, 0.153846, 0.25641, 0.179487, 0.282051, 0.128205, 0.076923, 0.025641, 0.153846, 0.076923])
    carries = np.array([[t in c for t in range(10)] for c in cells])
    mass = quota.rake(counts, carries, shares) * counts
    assert np.allclose(mass @ carries / mass.sum(), shares, atol=1e-4)


def test_rake_shares_out_of_reach():
    counts, carries = np.array([10, 10, 10]), np.array([[True, False, False], [False, True, False], [False, False, True]])
    mass = quota.rake(counts, carries, np.array([0.5, 0.4, 0.4])) * counts  # 0.3 too much, so each gives way by 0.1 whatever the order
    assert np.allclose(mass / mass.sum(), [0.4, 0.3, 0.3], atol=1e-3)
    assert np.allclose(quota.rake(counts, carries, np.array([0.0, 1.0, 0.0])), 1)


def test_repair_against_all_compositions():
    r = np.random.default_rng(2)
    for _ in range(30):
        have, carries = r.integers(1, 4, 5), (r.random((5, 4)) < 0.4).astype(int)
        size = int(have.sum()) // 2
        drawn = r.multivariate_hypergeometric(have, size)
        floors, asks = r.integers(0, 2, 4), r.integers(0, 5, 4)
        got = quota.repair(have, drawn, carries, floors, asks)
        assert got.sum() == size and (got >= 0).all() and (got <= have).all()
        supply = have @ carries
        low, high = np.minimum(floors, supply), np.minimum(np.maximum(floors, asks), supply)
        cost = lambda k: (100 * np.maximum(low - k @ carries, 0) + np.maximum(high - k @ carries, 0)).sum()
        every = [k for k in np.ndindex(*(have + 1)) if sum(k) == size]
        assert cost(got) == min(cost(np.array(k)) for k in every)
        if cost(drawn) == 0:
            assert (got == drawn).all()


def test_report_names_shares_that_cannot_be_met_together(spark):
    rows = [(f"{c}{n}", b, c, "", "accepted_negative", "q", "q") for b in (1, 2) for c in ("aaaaaa", "bbbbbb") for n in range(30)]
    images = spark.createDataFrame(rows, IMAGES)
    t = [(b, "CandidateCategory", c, s, 0, 10) for b, s in ((1, 0.5), (2, 0.8)) for c in ("aaaaaa", "bbbbbb")]
    targets = spark.createDataFrame([*t, (3, "CandidateCategory", "aaaaaa", 0.5, 0, 10)], TARGETS)
    report = {(x["negative_batch"], x["target_value"]): x for x in quota.sample_report(quota.target_sample(images, targets), images, targets).collect()}
    assert {k for k, x in report.items() if not x["share_met"]} == {(2, "aaaaaa"), (2, "bbbbbb"), (3, "aaaaaa")}
    assert report[2, "aaaaaa"]["can_be_met"] and report[2, "aaaaaa"]["raked_share"] == pytest.approx(0.5)


def test_sample_meets_shares_minimums_and_skew(spark):
    r = random.Random(9)
    cats = ["aaaaaa"] * 80 + ["bbbbbb"] * 15 + ["cccccc"] * 5
    rows = [(f"i{n}", 1 if n % 3 else n % 7 + 2, r.choice(cats), r.choice(["x", "y", "x;y", ""]), "accepted_negative", "q", "q") for n in range(6000)]
    rows += [("rare", 1, "zzzzzz", "", "accepted_negative", "q", "q")]
    images = spark.createDataFrame(rows, IMAGES)
    t = [(b, "CandidateCategory", c, s, m, 200) for b in range(1, 9) for c, s, m in (("aaaaaa", 0.4, 2), ("bbbbbb", 0.4, 2), ("cccccc", 0.2, 2), ("zzzzzz", 0.0, 1))]
    t += [(b, "MatchedClasses", "x", 0.5, 0, 200) for b in range(1, 9)]
    targets = spark.createDataFrame(t, TARGETS)
    sample = quota.target_sample(images, targets, salt_rows=500)
    got = sample.where("negative_batch = 1").collect()
    assert len(got) == 200
    count = lambda tag: sum(tag in x["profile"] for x in got)
    assert abs(count("CandidateCategory=bbbbbb") - 80) < 25 and abs(count("CandidateCategory=cccccc") - 40) < 20
    assert count("CandidateCategory=zzzzzz") == 1
    whole = {(x["negative_batch"], x["image"]) for x in sample.collect()}
    again = {(x["negative_batch"], x["image"]) for x in quota.target_sample(images.repartition(11), targets, salt_rows=100_000).collect()}
    assert whole == again


@pytest.mark.parametrize("crowded", [4_000_000, 3])
def test_overlap_against_brute_force(spark, crowded):
    r = random.Random(6)
    flip = lambda h, n: f"{int(h, 16) ^ sum(1 << b for b in r.sample(range(64), n)):016x}"
    recs, prints = [], []
    for i in range(160):
        s = r.choice(["train", "Training ", "val", "TEST", None])
        p = "0" * 16 if r.random() < 0.2 else f"{r.getrandbits(64):016x}"
        h = (p, f"{r.getrandbits(64):016x}", f"{r.getrandbits(64):064x}")
        w, hgt = r.choice([(640, 480), (480, 640), (None, 480), (640, 0)])
        if prints and r.random() < 0.4:
            j = r.randrange(len(prints))
            h = (flip(prints[j][1], r.randint(0, 9)), flip(prints[j][2], r.randint(0, 11)), prints[j][3] if r.random() < 0.3 else h[2])
        recs.append((f"d__{i:016x}", s, "included" if r.random() < 0.9 else "excluded", "D-1"))
        prints.append((f"d__{i:016x}", h[0], h[1], h[2], w, hgt))
    recs += [(x[0].upper() + ".PNG", "train", "included", "d 1") for x in recs[:20]] + recs[:10] + [(None, "train", "included", "d")]
    prints_rows = [(a, b.upper() if i % 5 == 0 else b, c, d.upper() if i % 3 == 0 else d, w, h) for i, (a, b, c, d, w, h) in enumerate(prints)]
    prints_rows += prints_rows[:15] + [(None, "0" * 16, "0" * 16, "x", 1, 1), ("d__bad", "zz", None, "", 5, 5)]
    m = spark.createDataFrame(recs, "canonical_id string, avax_split string, split_status string, source_dataset string").withColumns({"train": F.lit(1), "phash": F.lit("clash")})
    f = spark.createDataFrame(prints_rows, "canonical_id string, phash string, dhash string, pixel_sha256 string, width int, height int").withColumns({"aspect": F.lit("clash"), "train": F.lit(2)})
    pairs = overlap.overlap_pairs(m, f, crowded=crowded)
    got = {tuple(x) for x in overlap.overlap_found(pairs).collect()}
    side = {"train": "t", "Training ": "t", "val": "e", "TEST": "e"}
    known = [(i, side[s]) for i, s, st, _ in set(recs) if i and s and st == "included"]
    by = {}
    for p in prints_rows:
        by.setdefault(p[0], set()).add((p[1].lower(), p[2], p[3].lower(), p[4], p[5]))
    key = lambda i: i.lower().removesuffix(".png")
    want = set()
    for a, sa in known:
        for b, sb in known:
            if sa == "e" and sb == "t" and a != b:
                hit = key(a) == key(b)
                for x in by.get(a, ()):
                    for y in by.get(b, ()):
                        hit |= x[2] == y[2]
                        if all(v for v in (*x[3:], *y[3:])):
                            q, u = x[3] / x[4], y[3] / y[4]
                            hit |= (int(x[0], 16) ^ int(y[0], 16)).bit_count() <= 8 and (int(x[1], 16) ^ int(y[1], 16)).bit_count() <= 10 and abs(q - u) / max(q, u) <= 0.15
                if hit:
                    want.add((min(a, b), max(a, b)))
    assert got == want and want
    report = overlap.overlap_report(pairs, m).collect()
    assert {r["source_dataset"] for r in report} == {"d1"} and sum(r["pairs"] for r in report) == pairs.count()
    assert overlap.overlap_pairs(m.where("false"), f.where("false")).count() == 0


def test_invariants_of_empty_tables(spark):
    images, targets = spark.createDataFrame([], IMAGES), spark.createDataFrame([(1, "CandidateCategory", "a", 0.5, 2, 10)], TARGETS)
    sample = quota.target_sample(images, targets)
    assert quota.sample_invariants(sample, images, targets).count() == 0
    rows = spark.createDataFrame([("a1", 1, "a", "", "accepted_negative", "q", "q")], IMAGES)
    got = [tuple(x) for x in quota.sample_invariants(quota.target_sample(rows, targets), rows, targets).collect()]
    assert got == [(1, 1, 1, 0, 0)]
