"""Contracts over the test tables, and operators whose result is whether something holds."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix import contracts as con
from curatrix.functions import geometry as geo
from curatrix.functions import text as tx
from curatrix.functions.hashing import table_digest
from curatrix.operators import audit, joins, review
from curatrix.plans.registry import Book
from curatrix.session import forget_folder, shared_folder, table
from curatrix.streaming import decisions

BOOK = Book()


def _holds(spark: SparkSession, cases: dict[str, Callable[[], object]]) -> DataFrame:
    """``case, holds``: whether each check passes; any error but a broken contract is one."""
    rows = []
    for name, check in cases.items():
        try:
            check()
            rows.append((name, True))
        except con.ContractError:
            rows.append((name, False))
    return spark.createDataFrame(rows, "case string, holds boolean")


def _sql(cases: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS \"case\", ({c}) AS holds" for n, c in cases.items())


_COLUMN = "SELECT count(*) > 0 FROM duckdb_columns() WHERE table_name = '{}' AND column_name = '{}'"


@BOOK.query(_sql({"orders.o_custkey": _COLUMN.format("orders", "o_custkey"), "orders.c_custkey": _COLUMN.format("orders", "c_custkey"), "fingerprints.phash": _COLUMN.format("fingerprints", "phash")}))
def required_columns(spark: SparkSession, folder: str) -> DataFrame:
    t = lambda n: table(spark, folder, n)
    return _holds(spark, {
        "orders.o_custkey": lambda: con.require_columns(t("orders"), ["o_orderkey", "o_custkey"]),
        "orders.c_custkey": lambda: con.require_columns(t("orders"), ["o_orderkey", "c_custkey"]),
        "fingerprints.phash": lambda: con.require_columns(t("fingerprints"), ["phash"]),
    })


@BOOK.query(_sql({
    "nations": "SELECT count(*) = 25 FROM nation", "regions of nations": "SELECT count(*) FILTER (n_regionkey = 0) = 5 FROM nation", "orders are lines": "SELECT count(*) = (SELECT count(*) FROM lineitem) FROM orders",
    "negatives have no boxes": "SELECT count(*) FILTER (is_negative) = count(*) FILTER (plate_instance_count = 0) FROM baseline_split_manifest",
}))
def expected_counts(spark: SparkSession, folder: str) -> DataFrame:
    n, o, m = (table(spark, folder, x) for x in ("nation", "orders", "baseline_split_manifest"))
    empty = m.agg(F.count_if(F.coalesce(F.col("plate_instance_count") == 0, F.lit(False)))).first()[0]
    lines = table(spark, folder, "lineitem").count()
    return _holds(spark, {
        "nations": lambda: con.require_counts(n, {"all": (None, 25)}),
        "regions of nations": lambda: con.require_counts(n, {"all": (None, 25), "first": (F.col("n_regionkey") == 0, 5)}),
        "orders are lines": lambda: con.require_counts(o, {"all": (None, lines)}),
        "negatives have no boxes": lambda: con.require_counts(m, {"negative": (F.col("is_negative"), empty)}),
    })


@BOOK.query(_sql({
    "orders": "SELECT count(*) = count(DISTINCT o_orderkey) FROM orders", "lines": "SELECT count(*) = count(DISTINCT l_orderkey) FROM lineitem",
    "manifest": "SELECT count(*) = count(DISTINCT canonical_id) FROM baseline_split_manifest", "names": "SELECT count(*) = count(n_name) FROM nation", "hashes": "SELECT count(*) = count(phash) FROM fingerprints",
    "split reasons": "SELECT count(*) = count(split_exclusion_reason) FROM baseline_split_manifest",
}))
def unique_and_complete(spark: SparkSession, folder: str) -> DataFrame:
    t = lambda n: table(spark, folder, n)
    return _holds(spark, {
        "orders": lambda: con.require_unique(t("orders"), ["o_orderkey"]), "lines": lambda: con.require_unique(t("lineitem"), ["l_orderkey"]), "manifest": lambda: con.require_unique(t("baseline_split_manifest"), ["canonical_id"]),
        "names": lambda: con.require_complete(t("nation"), ["n_name"]), "hashes": lambda: con.require_complete(t("fingerprints"), ["phash"]), "split reasons": lambda: con.require_complete(t("baseline_split_manifest"), ["split_exclusion_reason"]),
    })


_STATES = ["accepted_negative", "rejected", "unsure"]


@BOOK.query(_sql({
    "order status": "SELECT bool_and(coalesce(o_orderstatus IN ('F', 'O', 'P'), false)) FROM orders", "order status without P": "SELECT bool_and(coalesce(o_orderstatus IN ('F', 'O'), false)) FROM orders",
    "review status": f"SELECT bool_and(coalesce(ReviewStatus IN ({', '.join(map(repr, _STATES))}), false)) FROM accepted_negatives_batch2_metadata", "allowed split or null": "SELECT bool_and(coalesce(allowed_split IN ('TRAIN_ONLY', 'ANY'), true)) FROM fingerprints",
}))
def enum_domains(spark: SparkSession, folder: str) -> DataFrame:
    t = lambda n: table(spark, folder, n)
    return _holds(spark, {
        "order status": lambda: con.require_domain(t("orders"), "o_orderstatus", ["F", "O", "P"]), "order status without P": lambda: con.require_domain(t("orders"), "o_orderstatus", ["F", "O"]),
        "review status": lambda: con.require_domain(t("accepted_negatives_batch2_metadata"), "ReviewStatus", _STATES), "allowed split or null": lambda: con.require_domain(t("fingerprints"), "allowed_split", ["TRAIN_ONLY", "ANY"], nullable=True),
    })


@BOOK.query(_sql({
    "negatives have no plates": "SELECT count(*) FILTER (is_negative AND plate_instance_count > 0) = 0 FROM baseline_split_manifest", "positives have plates": "SELECT count(*) FILTER (NOT is_negative AND plate_instance_count = 0) = 0 FROM baseline_split_manifest",
    "quantities are whole": "SELECT bool_and(coalesce(l_quantity = floor(l_quantity), false)) FROM lineitem", "prices are whole": "SELECT bool_and(coalesce(l_extendedprice = floor(l_extendedprice), false)) FROM lineitem",
}))
def cross_field_rules(spark: SparkSession, folder: str) -> DataFrame:
    m, li = table(spark, folder, "baseline_split_manifest"), table(spark, folder, "lineitem")
    return _holds(spark, {
        "negatives have no plates": lambda: con.require_none(m, F.col("is_negative") & (F.col("plate_instance_count") > 0), "negative with plates"),
        "positives have plates": lambda: con.require_none(m, ~F.col("is_negative") & (F.col("plate_instance_count") == 0), "positive without plates"),
        "quantities are whole": lambda: con.require_none(li, ~con.integral(F.col("l_quantity")), "quantity"),
        "prices are whole": lambda: con.require_none(li, ~con.integral(F.col("l_extendedprice")), "price"),
    })


@BOOK.query(_sql({
    "orders have lines": "SELECT count(*) = 0 FROM (SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem UNION ALL (SELECT l_orderkey FROM lineitem EXCEPT SELECT o_orderkey FROM orders))",
    "customers": "SELECT count(*) = 0 FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)", "itself": "SELECT true",
}))
def expected_sets(spark: SparkSession, folder: str) -> DataFrame:
    k = lambda n, c: table(spark, folder, n).select(F.col(c).alias("k"))
    both = k("customer", "c_custkey").join(k("orders", "o_custkey").distinct(), "k", "left_semi")
    return _holds(spark, {
        "orders have lines": lambda: con.require_same_set(k("orders", "o_orderkey"), k("lineitem", "l_orderkey"), "k"),
        "customers": lambda: con.require_same_set(k("customer", "c_custkey"), both, "k"), "itself": lambda: con.require_same_set(k("nation", "n_name"), k("nation", "n_name"), "k"),
    })


@BOOK.query(_sql({
    "pinned": "SELECT bool_and(sha256(r_name) = sha256('AFRICA')) FROM region WHERE r_regionkey = 0", "all regions": "SELECT bool_and(sha256(r_name) = sha256('AFRICA')) FROM region",
    "unchanged": "SELECT true", "changed": "SELECT count(*) FILTER (n_regionkey = 1) = 0 FROM nation",
}))
def digest_pins(spark: SparkSession, folder: str) -> DataFrame:
    """One value's digest against a pin, and a whole table's before and after a change."""
    import hashlib

    pin, region, nation = hashlib.sha256(b"AFRICA").hexdigest().upper(), table(spark, folder, "region"), table(spark, folder, "nation")
    digest, cols = F.sha2("r_name", 256), ["n_nationkey", "n_name"]
    before = tuple(nation.agg(*table_digest(*cols)).first())
    changed = nation.withColumn("n_name", F.when(F.col("n_regionkey") == 1, F.lower("n_name")).otherwise(F.col("n_name")))
    return _holds(spark, {
        "pinned": lambda: con.require_digest(region.where("r_regionkey = 0"), digest, pin), "all regions": lambda: con.require_digest(region, digest, pin),
        "unchanged": lambda: con.require_unchanged(nation.repartition(3), cols, before), "changed": lambda: con.require_unchanged(changed, cols, before),
    })


@BOOK.query(_sql({
    "frozen": "SELECT max(target_share) = 0.8 FROM split_targets", "other share": "SELECT max(target_share) = 0.7 FROM split_targets", "too early": "SELECT count(*) FILTER (split_name = 'test') = 0 FROM split_targets",
}))
def frozen_selection(spark: SparkSession, folder: str) -> DataFrame:
    """A selection made of the split targets, before a stage that may run once."""
    row = table(spark, folder, "split_targets").agg(F.max("target_share").alias("share"), F.count_if(F.col("split_name") == "test").alias("tests")).first()
    selection = {"share": row["share"], "test_seen": row["tests"] > 0}
    return _holds(spark, {
        "frozen": lambda: con.require_frozen(selection, {"share": 0.8}), "other share": lambda: con.require_frozen(selection, {"share": 0.7}), "too early": lambda: con.require_frozen(selection, {"share": 0.8}, ["test_seen"]),
    })


_DISTINCT_M = "m AS (SELECT canonical_id, min(source_group) AS g, min(plate_instance_count) AS n FROM baseline_split_manifest WHERE canonical_id IS NOT NULL GROUP BY 1)"
_DISTINCT_F = "f AS (SELECT canonical_id, min(source_group) AS g, max(width) AS width FROM fingerprints WHERE canonical_id IS NOT NULL GROUP BY 1)"


def _keyed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    m = table(spark, folder, "baseline_split_manifest").where("canonical_id is not null").groupBy("canonical_id").agg(F.min("source_group").alias("g"), F.min("plate_instance_count").alias("n"))
    f = table(spark, folder, "fingerprints").where("canonical_id is not null").groupBy("canonical_id").agg(F.min("source_group").alias("g"), F.max("width").alias("width"))
    return m, f


@BOOK.query(f"WITH {_DISTINCT_M}, {_DISTINCT_F} SELECT canonical_id, m.g, n, width FROM m LEFT JOIN f USING (canonical_id)")
def one_to_one_join(spark: SparkSession, folder: str) -> DataFrame:
    return joins.checked_left_join(*_keyed(spark, folder), ["canonical_id"], "one_to_one").select("canonical_id", "g", "n", "width")


@BOOK.query(f"WITH {_DISTINCT_M}, {_DISTINCT_F} SELECT m.canonical_id, m.g, n, width FROM m LEFT JOIN f ON f.canonical_id = m.canonical_id AND f.g = m.g")
def composite_key_join(spark: SparkSession, folder: str) -> DataFrame:
    return joins.checked_left_join(*_keyed(spark, folder), ["canonical_id", "g"], "one_to_one").select("canonical_id", "g", "n", "width")


@BOOK.query("""
WITH r AS (SELECT n_nationkey, (n_nationkey * 7) % 25 AS position FROM nation WHERE n_regionkey <> 2)
SELECT n_nationkey, n_name, row_number() OVER (ORDER BY position NULLS LAST, n_nationkey) AS place FROM nation LEFT JOIN r USING (n_nationkey)
""")
def review_order(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in the order of a review; those it doesn't have come last."""
    n = table(spark, folder, "nation").select("n_nationkey", "n_name")
    r = table(spark, folder, "nation").where("n_regionkey <> 2").select("n_nationkey", ((F.col("n_nationkey") * 7) % 25).alias("position"))
    rows = joins.in_order_of(n, r, "n_nationkey", "position").select("n_nationkey", "n_name").collect()  # 25 rows
    return spark.createDataFrame([(*x, i + 1) for i, x in enumerate(rows)], "n_nationkey int, n_name string, place long")


@BOOK.query("SELECT o_custkey AS user_id, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ';') AS members FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) >= 3")
def grouped_members(spark: SparkSession, folder: str) -> DataFrame:
    rows = audit.members(table(spark, folder, "orders"), "o_custkey", "o_orderpriority", 3)
    return rows.select(F.col("o_custkey").alias("user_id"), F.array_join("members", ";").alias("members"))


@BOOK.query("""
SELECT c_custkey AS "group", CASE WHEN c_custkey % 3 = 0 THEN 'a' ELSE 'b' END || c_custkey AS keep_id, CASE WHEN c_custkey % 3 = 0 THEN 'b' ELSE 'a' END || c_custkey AS exclude_id FROM customer
""")
def adjudicated_pairs(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col("c_custkey")
    rows = table(spark, folder, "customer").select(c.alias("group"), F.concat(F.lit("a"), c).alias("first"), F.concat(F.lit("b"), c).alias("second"), F.concat(F.when(c % 3 == 0, "a").otherwise("b"), c).alias("keep"))
    return review.adjudicate(rows, "group", "first", "second", "keep")


@BOOK.query("""
WITH a AS (SELECT ts, event_id FROM events WHERE event_type = 'click' ORDER BY ts, event_id LIMIT 200), s AS (SELECT ts, event_id FROM a ORDER BY ts DESC, event_id DESC LIMIT 1)
SELECT e.event_id, e.event_type FROM events e, s WHERE (SELECT count(*) FROM a) < 200 OR e.ts < s.ts OR (e.ts = s.ts AND e.event_id <= s.event_id)
""")
def until_target(spark: SparkSession, folder: str) -> DataFrame:
    """The log up to the decision that reaches the target."""
    return review.until_target(table(spark, folder, "events"), ["ts", "event_id"], F.col("event_type") == "click", 200).select("event_id", "event_type")


@BOOK.query("SELECT user_id, max_by(event_type, (ts, event_type)) AS event_type FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def saved_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """A log that arrives as a stream, its latest decisions kept after every batch and read from the newest version."""
    place = forget_folder(f"{shared_folder(spark)}/decisions-{uuid.uuid4().hex}")
    events = table(spark, folder, "events").select("user_id", "event_type", "ts")
    events.repartition(4).write.parquet(f"{place}/log")
    stream = decisions.read_log(spark, f"{place}/log", "user_id bigint, event_type string, ts timestamp")
    decisions.keep_latest(stream, f"{place}/latest", f"{place}/progress", "user_id", "event_type", "ts").awaitTermination()
    return decisions.latest_version(spark, f"{place}/latest").select("user_id", "event_type")


@BOOK.query("SELECT c_custkey AS customer, c_name AS name, c_nationkey AS nation FROM customer")
def aliased_headers(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select(F.col("c_custkey").alias(" Customer ID "), F.col("c_name").alias("NAME"), F.col("c_nationkey").alias("country"))
    return tx.alias_headers(rows, {"customer": ["customer id"], "name": ["full name"], "nation": ["Country", "land"]}).select("customer", "name", "nation")


_NAMES = ["License-Plate", "number plate", "licence_plate", "PLATE", "wheel", "plates", " license plate "]


@BOOK.query(f"SELECT p_partkey, p_partkey % 7 IN (0, 1, 2, 3, 6) AS is_plate, upper(regexp_replace(p_name || '-' || p_size, '[^A-Za-z0-9]+', '', 'g')) AS plain FROM part")
def plate_classes(spark: SparkSession, folder: str) -> DataFrame:
    name = F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("p_partkey") % len(_NAMES) + 1).cast("int"))
    return table(spark, folder, "part").select("p_partkey", tx.is_plate_class(name).alias("is_plate"), tx.ocr_plain(F.concat("p_name", F.lit("-"), "p_size")).alias("plain"))


_FORMS = """SELECT l_orderkey AS image, l_linenumber AS line, l_partkey AS p, (l_partkey % 90)::DOUBLE AS x0, (l_suppkey % 70)::DOUBLE AS y0, (l_partkey % 90 + l_quantity % 30 - 3)::DOUBLE AS x1, (l_suppkey % 70 + l_linenumber * 6)::DOUBLE AS y1 FROM lineitem"""


def _forms(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    return table(spark, folder, "lineitem").select(
        c("l_orderkey").alias("image"), c("l_linenumber").alias("line"), c("l_partkey").alias("p"), (c("l_partkey") % 90).cast("double").alias("x0"), (c("l_suppkey") % 70).cast("double").alias("y0"),
        (c("l_partkey") % 90 + c("l_quantity") % 30 - 3).cast("double").alias("x1"), (c("l_suppkey") % 70 + c("l_linenumber") * 6).cast("double").alias("y1"),
    )


@BOOK.query(f"""
SELECT image, line, p, round((x0 + x1) / 2 / 100, 9) AS cx, round((y0 + y1) / 2 / 80, 9) AS cy, round((x1 - x0) / 100, 9) AS w, round((y1 - y0) / 80, 9) AS h,
  round((x0 / 100 + x1 / 100) / 2, 9) AS unit_cx, round(y1 / 80 - y0 / 80, 9) AS unit_h, round(x0 / 100, 9) AS back_x0, round(y1 / 80, 9) AS back_y1, true AS same FROM ({_FORMS})
""")
def corner_convert(spark: SparkSession, folder: str) -> DataFrame:
    """Corners in pixels and in units to the centre form and back, compared within a tolerance."""
    b, w, h = _forms(spark, folder), F.lit(100.0), F.lit(80.0)
    box = tuple(F.col(c) for c in ("x0", "y0", "x1", "y1"))
    c = geo.xyxy_to_centre(*box, w, h)
    unit = geo.xyxy_to_centre(box[0] / w, box[1] / h, box[2] / w, box[3] / h)
    back = geo.centre_to_xyxy(*c)
    same = geo.close_to(c[0], unit[0]) & geo.close_to(c[3], unit[3]) & geo.close_to(back[0] * w, box[0])
    r = lambda x, n: F.round(x, 9).alias(n)
    return b.select("image", "line", "p", *(r(x, n) for x, n in zip(c, ("cx", "cy", "w", "h"))), r(unit[0], "unit_cx"), r(unit[3], "unit_h"), r(back[0], "back_x0"), r(back[3], "back_y1"), same.alias("same"))


_VARIANTS = f"""v AS (SELECT *, CASE p % 11 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN 'Infinity'::DOUBLE WHEN 2 THEN NULL ELSE x1 END AS q FROM ({_FORMS})),
u AS (SELECT *, q IS NOT NULL AND NOT isnan(q) AND NOT isinf(q) AS ok, (x0 + q) / 2 / 100 AS cx, (y0 + y1) / 2 / 80 AS cy, (q - x0) / 100 AS w, (y1 - y0) / 80 AS h FROM v)"""
_OUT = "least(cx - w / 2, cy - h / 2, 1 - (cx + w / 2), 1 - (cy + h / 2))"


@BOOK.query(f"""
WITH {_VARIANTS}, e AS (SELECT ok, CASE WHEN NOT ok THEN 'not_finite' ELSE concat_ws(';', CASE WHEN q <= x0 OR y1 <= y0 THEN 'inverted' END, CASE WHEN x0 < 0 OR y0 < 0 OR q > 95 OR y1 > 80 THEN 'outside' END) END AS corners,
  CASE WHEN NOT ok THEN 'not_finite' ELSE concat_ws(';', CASE WHEN q - x0 <= 0 OR y1 - y0 <= 0 THEN 'not_positive' END, CASE WHEN q > 95 OR y1 > 80 THEN 'outside' END) END AS sized,
  CASE WHEN NOT ok THEN 'not_finite' ELSE concat_ws(';', CASE WHEN cx < -0.01 OR cx > 1.01 OR cy < -0.01 OR cy > 1.01 THEN 'centre' END, CASE WHEN {_OUT} < -0.05 THEN 'corner' END, CASE WHEN w <= 0 OR h <= 0 OR w > 1.01 OR h > 1.01 THEN 'size' END) END AS centred FROM u)
SELECT ok, corners, sized, centred, count(*) AS row_count FROM e GROUP BY ALL
""")
def box_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The rules of all three box forms, with slack, over boxes that also hold NaN, infinity and null."""
    p = F.col("p") % 11
    q = F.when(p == 0, float("nan")).when(p == 1, float("inf")).when(p == 2, F.lit(None)).otherwise(F.col("x1"))
    b = _forms(spark, folder).withColumn("q", q)
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "q", "y1"))
    size, join = (F.lit(95.0), F.lit(80.0)), lambda e, n: F.array_join(e, ";").alias(n)
    centre = geo.xyxy_to_centre(x0, y0, x1, y1, 100.0, 80.0)
    rows = b.select(
        geo.is_finite(x1).alias("ok"), join(geo.box_errors((x0, y0, x1, y1), "xyxy", size), "corners"), join(geo.box_errors((x0, y0, x1 - x0, y1 - y0), "xywh", size), "sized"),
        join(geo.box_errors(centre, "cxcywh", slack=0.01, corner_slack=0.05), "centred"),
    )
    return rows.groupBy("ok", "corners", "sized", "centred").agg(F.count(F.lit(1)).alias("row_count"))
