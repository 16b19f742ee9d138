import random
import re

import pytest
from pyspark.sql import functions as F

from curatrix import contracts as c


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([("a", "train", "g", "REAL", "TRAIN_ONLY", "p", 1), ("b", "val", "h", "REAL", "ANY", "q", 0)], "id string, split string, source_group string, real_synthetic string, allowed_split string, pixel_sha256 string, n int")


def test_contracts_hold(rows):
    c.require_columns(rows, ["id"])
    c.require_counts(rows, {"all": (None, 2), "val": (F.col("split") == "val", 1)})
    c.require_unique(rows, ["id"])
    c.require_complete(rows, ["id"])
    c.require_domain(rows, "split", ["train", "val"])
    c.require_none(rows, (F.col("n") == 0) & (F.col("split") == "train"), "empty")
    c.require_policy(rows)
    c.require_same_set(rows, rows, "id")
    c.require_frozen({"point": 0.2}, {"point": 0.2}, ["test_seen"])


@pytest.mark.parametrize("check", [
    lambda r: c.require_columns(r, ["zzz"]),
    lambda r: c.require_counts(r, {"all": (None, 3)}),
    lambda r: c.require_unique(r.union(r), ["id"]),
    lambda r: c.require_complete(r.withColumn("id", F.lit(None)), ["id"]),
    lambda r: c.require_domain(r, "split", ["train"]),
    lambda r: c.require_domain(r.withColumn("split", F.lit(None).cast("string")), "split", ["train"]),
    lambda r: c.require_none(r, F.col("n") == 0, "negatives"),
    lambda r: c.require_policy(r.withColumn("source_group", F.lit("g"))),
    lambda r: c.require_policy(r.withColumn("pixel_sha256", F.lit("p"))),
    lambda r: c.require_policy(r.withColumn("real_synthetic", F.lit("SYNTHETIC"))),
    lambda r: c.require_policy(r.withColumn("allowed_split", F.lit("TRAIN_ONLY"))),
    lambda r: c.require_same_set(r, r.where("id = 'a'"), "id"),
    lambda r: c.require_digest(r, F.col("pixel_sha256"), "P"),
    lambda r: c.require_frozen({"point": 0.3}, {"point": 0.2}),
    lambda r: c.require_frozen({"test_seen": True}, {}, ["test_seen"]),
])
def test_contracts_fail(rows, check):
    with pytest.raises(c.ContractError):
        check(rows)


@pytest.mark.parametrize("few", [200_000, 0])
def test_policy_against_brute_force_and_its_shuffles(spark, few):
    r = random.Random(8)
    pick = lambda *x: r.choice(x)
    rows = [(f"i{i}", pick("train", "train", "val", "test", "Val", None), pick(None, *map(str, range(60))), pick("REAL", "SYNTHETIC", None), pick("ANY", "TRAIN_ONLY", None), pick(None, *map(str, range(80)))) for i in range(300)]
    df = spark.createDataFrame(rows, "canonical_id string, split string, source_group string, real_synthetic string, allowed_split string, pixel_sha256 string").repartition(3)
    links = [(f"i{r.randrange(320)}", pick(None, f"i{r.randrange(320)}"), pick("", None, "unsure ", "same")) for _ in range(400)]
    pairs = spark.createDataFrame(links, "x string, y string, status string").repartition(3)
    own = [x for x in rows if x[1] in ("train", "val", "test")]
    at = {x[0]: x[1] for x in own}
    several = lambda k: sum(len({x[1] for x in own if x[k] == v}) > 1 for v in {x[k] for x in own} - {None})
    want = {
        "synthetic_in_eval": sum(x[1] != "train" and x[3] == "SYNTHETIC" for x in own), "train_only_in_eval": sum(x[1] != "train" and x[4] == "TRAIN_ONLY" for x in own),
        "synthetic_share": 1, "group_in_several": several(2), "pixels_in_several": several(5),
        "unresolved_near_pairs": sum(a in at and b in at and at[a] != at[b] and (s or "").strip() in ("", "unsure") for a, b, s in links),
    }
    out = c.policy_violations(df, near_pairs=pairs, few=few)
    assert {x["rule"]: x["violations"] for x in out.collect()} == want and 0 not in want.values()
    plan = out._jdf.queryExecution().sparkPlan().toString() + out._jdf.queryExecution().executedPlan().toString()
    for shared in ("source_group", "pixel_sha256"):  # each row is shuffled once
        assert len(re.findall(rf"hashpartitioning\({shared}#\d+(?:, split#\d+)?, \d+\)", plan.split("== Initial Plan ==")[-1])) == 1
    assert ("LeftSemi" in plan) == (few > 0)


def test_identity_and_integral(spark):
    a = spark.createDataFrame([("x", "1"), ("y", "1"), ("z", "1")], "k string, d string")
    b = spark.createDataFrame([("x", "1"), ("y", "2"), ("w", "1")], "k string, d string")
    assert {tuple(r) for r in c.identity_differences(a, b, "k", "d").collect()} == {("y", "changed"), ("z", "missing"), ("w", "unexpected")}
    df = spark.createDataFrame([(1.0,), (1.5,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(c.integral(F.col("x"))).collect()] == [True, False, False, False]


def test_unresolved_near_pairs_and_changes(spark, rows):
    pairs = spark.createDataFrame([("a", "b", None), ("b", "a", " Unsure"), ("a", "b", "same"), ("a", "zz", ""), ("a", "a", "")], "x string, y string, status string")
    found = {r["rule"]: r["violations"] for r in c.policy_violations(rows, near_pairs=pairs, key="id").collect()}
    assert found["unresolved_near_pairs"] == 2 and sum(found.values()) == 2
    assert {r["rule"]: r["violations"] for r in c.policy_violations(rows, near_pairs=pairs.where("false"), key="id").collect()}["unresolved_near_pairs"] == 0
    from curatrix.functions.hashing import table_digest

    pin = tuple(rows.agg(*table_digest("id", "n")).first())
    c.require_unchanged(rows.repartition(5), ["id", "n"], pin)
    with pytest.raises(c.ContractError):
        c.require_unchanged(rows.union(rows), ["id", "n"], pin)
    assert tuple(rows.where("false").agg(*table_digest("id")).first()) == (0, "0")
