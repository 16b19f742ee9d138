import datetime as dt

from curatrix.streaming import decisions

SCHEMA = "k string, s string, at timestamp"


def test_latest_and_windows(spark, tmp_path):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    source, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    spark.createDataFrame([("a", "x", t(1)), ("a", "y", t(2)), ("b", "p", t(1))], SCHEMA).write.parquet(source)
    decisions.keep_latest(decisions.read_log(spark, source, SCHEMA), target, mark, "k", "s", "at").awaitTermination()
    spark.createDataFrame([("a", "old", t(1)), ("b", "q", t(5)), ("c", "n", t(3))], SCHEMA).write.mode("append").parquet(source)
    decisions.keep_latest(decisions.read_log(spark, source, SCHEMA), target, mark, "k", "s", "at").awaitTermination()
    assert {(r["k"], r["s"]) for r in decisions.latest_version(spark, target).collect()} == {("a", "y"), ("b", "q"), ("c", "n")}
    counts = decisions.window_counts(decisions.read_log(spark, source, SCHEMA), "at", "s")
    q = counts.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("windows").count() == 6
