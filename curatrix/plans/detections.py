"""Detection evaluation over predictions and ground truth derived from lineitem.

Each line is a prediction in the image of its order; lines that weren't returned also
give a ground truth box shifted by a few pixels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.evaluate import detection as det
from curatrix.operators.review import index_in_group
from curatrix.plans.registry import Book
from curatrix.session import materialize, table

BOOK = Book()
CONFIDENCES = [0.15, 0.175, 0.2, 0.225, 0.25, 0.275, 0.3, 0.325, 0.35, 0.375, 0.4, 0.425, 0.45]
SUPPRESSIONS = [0.4, 0.45, 0.5, 0.55]

_BASE = """base AS (SELECT l_orderkey AS image_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_extendedprice)::INTEGER AS k, l_returnflag AS f,
  ((l_partkey * 7) % 60)::DOUBLE AS x, ((l_suppkey * 13) % 40)::DOUBLE AS y, 30 + l_quantity AS w, 12 + l_linenumber * 2.0::DOUBLE AS h, ((l_partkey % 89) + 10) / 100.0::DOUBLE AS score, ((l_suppkey % 9) - 4)::DOUBLE AS shift FROM lineitem),
pred AS (SELECT image_id, k AS pred_index, x AS x1, y AS y1, x + w AS x2, y + h AS y2, score FROM base),
gt AS (SELECT image_id, k AS gt_index, x + shift AS x1, y + shift AS y1, x + w + shift AS x2, y + h + shift AS y2 FROM base WHERE f <> 'R'),
o AS (SELECT p.image_id, p.pred_index, p.score, g.gt_index, CASE WHEN g.gt_index IS NOT NULL THEN greatest(least(p.x2, g.x2) - greatest(p.x1, g.x1), 0) * greatest(least(p.y2, g.y2) - greatest(p.y1, g.y1), 0) END AS i,
  (p.x2 - p.x1) * (p.y2 - p.y1) AS pa, (g.x2 - g.x1) * (g.y2 - g.y1) AS ga FROM pred p LEFT JOIN gt g USING (image_id)),
best AS (SELECT image_id, pred_index, score, max_by(gt_index, (i / greatest(pa + ga - i, 1e-9), -gt_index)) AS gt_index, max(CASE WHEN i IS NOT NULL THEN i / greatest(pa + ga - i, 1e-9) END) AS overlap FROM o GROUP BY 1, 2, 3)"""


def _outcome(least: float) -> str:
    return f"""out AS (SELECT *, CASE WHEN score < {least} THEN 'cut' WHEN coalesce(overlap >= 0.5, false) = false THEN 'fp' WHEN row_number() OVER (PARTITION BY image_id, coalesce(overlap >= 0.5, false), CASE WHEN overlap >= 0.5 THEN gt_index END, score >= {least} ORDER BY score DESC, pred_index) = 1 THEN 'tp' ELSE 'duplicate' END AS outcome FROM best)"""


_COUNTS = """c AS (SELECT count(*) FILTER (outcome = 'tp') AS tp, count(*) FILTER (outcome IN ('fp', 'duplicate')) AS fp, count(*) FILTER (outcome = 'duplicate') AS duplicate_detections,
  count(DISTINCT image_id) FILTER (outcome IN ('fp', 'duplicate') AND image_id NOT IN (SELECT image_id FROM gt)) AS negative_images_with_fp, count(*) FILTER (outcome IN ('fp', 'duplicate') AND image_id NOT IN (SELECT image_id FROM gt)) AS negative_fp_detections FROM out),
d AS (SELECT *, (SELECT count(*) FROM gt) - tp AS fn FROM c), e AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall FROM d)"""
_COLUMNS = "tp, fp, fn, round(precision, 9) AS precision, round(recall, 9) AS recall, round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 9) AS f1, duplicate_detections, negative_images_with_fp, negative_fp_detections"


def _data(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = index_in_group(table(spark, folder, "lineitem"), "l_orderkey", ["l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"])
    base = rows.select(
        F.col("l_orderkey").alias("image_id"), F.col("variant_index").alias("k"), "l_returnflag", ((F.col("l_partkey") * 7) % 60).cast("double").alias("x"), ((F.col("l_suppkey") * 13) % 40).cast("double").alias("y"),
        (F.col("l_quantity") + 30).alias("w"), (F.col("l_linenumber") * 2.0 + 12).alias("h"), ((F.col("l_partkey") % 89 + 10) / F.lit(100.0)).alias("score"), (F.col("l_suppkey") % 9 - 4).cast("double").alias("shift"),
    )
    corners = lambda d: [(F.col("x") + d).alias("x1"), (F.col("y") + d).alias("y1"), (F.col("x") + F.col("w") + d).alias("x2"), (F.col("y") + F.col("h") + d).alias("y2")]
    pred = base.select("image_id", F.col("k").alias("pred_index"), *corners(F.lit(0.0)), "score")
    return pred, base.where("l_returnflag <> 'R'").select("image_id", F.col("k").alias("gt_index"), *corners(F.col("shift")))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@BOOK.query(f"WITH {_BASE} SELECT image_id, pred_index, gt_index, round(overlap, 9) AS overlap FROM best WHERE overlap > 0")
def best_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    return det.best_overlaps(*_data(spark, folder)).where("overlap > 0").select("image_id", "pred_index", "gt_index", F.round("overlap", 9).alias("overlap"))


@BOOK.query(f"WITH {_BASE}, {_outcome(0)}, {_COUNTS} SELECT {_COLUMNS} FROM e")
def iou_match_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(det.match_counts(*_data(spark, folder)))


@BOOK.query(f"WITH {_BASE}, {_outcome(0.45)}, {_COUNTS} SELECT {_COLUMNS} FROM e")
def match_counts_confident(spark: SparkSession, folder: str) -> DataFrame:
    pred, truth = _data(spark, folder)
    return _rounded(det.match_counts(pred.where("score >= 0.45"), truth))


_PAIR_IOU = """greatest(least(a.x2, s.x2) - greatest(a.x1, s.x1), 0) * greatest(least(a.y2, s.y2) - greatest(a.y1, s.y1), 0) /
  greatest((a.x2 - a.x1) * (a.y2 - a.y1) + (s.x2 - s.x1) * (s.y2 - s.y1) - greatest(least(a.x2, s.x2) - greatest(a.x1, s.x1), 0) * greatest(least(a.y2, s.y2) - greatest(a.y1, s.y1), 0), 1e-9)"""
# the boxes of an image one by one, by falling score, beside the list of those kept so far
_NMS = f"""th AS (SELECT unnest({{thresholds}})::DOUBLE AS t), ordered AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, pred_index) AS r FROM pred WHERE score >= {{least}}),
nms AS (SELECT t, s.image_id, s.r, [{{{{'k': s.pred_index, 'x1': s.x1, 'y1': s.y1, 'x2': s.x2, 'y2': s.y2, 'score': s.score}}}}] AS kept FROM ordered s, th WHERE s.r = 1
  UNION ALL SELECT n.t, s.image_id, s.r, CASE WHEN len(list_filter(n.kept, lambda a: {_PAIR_IOU} > n.t)) > 0 THEN n.kept
    ELSE list_append(n.kept, {{{{'k': s.pred_index, 'x1': s.x1, 'y1': s.y1, 'x2': s.x2, 'y2': s.y2, 'score': s.score}}}}) END
  FROM nms n JOIN ordered s ON s.image_id = n.image_id AND s.r = n.r + 1),
last AS (SELECT t, image_id, unnest(max_by(kept, r)) AS u FROM nms GROUP BY t, image_id),
kept AS (SELECT t, image_id, u.k AS pred_index, u.x1 AS x1, u.y1 AS y1, u.x2 AS x2, u.y2 AS y2, u.score AS score FROM last)"""


@BOOK.query(f"WITH RECURSIVE {_BASE}, {_NMS.format(thresholds='[0.45]', least=0)} SELECT image_id, pred_index, x1, y1, x2, y2, score FROM kept")
def nms_keep(spark: SparkSession, folder: str) -> DataFrame:
    return det.suppress(_data(spark, folder)[0], 0.45)


_SWEEP = f"""WITH RECURSIVE {_BASE}, {_NMS.format(thresholds=SUPPRESSIONS, least=min(CONFIDENCES))},
cut AS (SELECT c, k.t, k.image_id, k.pred_index, k.score, b.gt_index, coalesce(b.overlap >= 0.5, false) AS hit FROM (SELECT unnest({CONFIDENCES})::DOUBLE AS c) x, kept k JOIN best b USING (image_id, pred_index) WHERE k.score >= c),
out AS (SELECT *, CASE WHEN NOT hit THEN 'fp' WHEN row_number() OVER (PARTITION BY c, t, image_id, hit, CASE WHEN hit THEN gt_index END ORDER BY score DESC, pred_index) = 1 THEN 'tp' ELSE 'duplicate' END AS outcome, image_id NOT IN (SELECT image_id FROM gt) AS negative FROM cut),
n AS (SELECT c, t, count(*) FILTER (outcome = 'tp') AS tp, count(*) FILTER (outcome <> 'tp') AS fp, count(*) FILTER (outcome = 'duplicate') AS duplicate_detections,
  count(DISTINCT image_id) FILTER (outcome <> 'tp' AND negative) AS negative_images_with_fp, count(*) FILTER (outcome <> 'tp' AND negative) AS negative_fp_detections FROM out GROUP BY 1, 2),
m AS (SELECT c AS confidence_threshold, t AS nms_threshold, 0.5::DOUBLE AS match_iou_threshold, *, (SELECT count(*) FROM gt) - tp AS fn FROM n),
e AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall FROM m),
sweep AS (SELECT confidence_threshold, nms_threshold, match_iou_threshold, {_COLUMNS} FROM e)"""


@BOOK.query(f"{_SWEEP} SELECT * FROM sweep")
def threshold_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(det.sweep(*_data(spark, folder), CONFIDENCES, SUPPRESSIONS))


@BOOK.query(f"{_SWEEP} SELECT * FROM sweep ORDER BY f1 DESC, nms_threshold, confidence_threshold LIMIT 1")
def best_f1(spark: SparkSession, folder: str) -> DataFrame:
    return det.best_point(threshold_sweep(spark, folder))


@BOOK.query(f"""{_SWEEP}, p AS (SELECT * FROM sweep WHERE confidence_threshold = 0.225 AND nms_threshold = 0.45)
SELECT confidence_threshold, nms_threshold, unnest(['tp', 'fp', 'fn', 'duplicate_detections', 'negative_images_with_fp', 'negative_fp_detections']) AS measure,
  unnest([tp, fp, fn, duplicate_detections, negative_images_with_fp, negative_fp_detections]) AS swept, unnest([tp, fp, fn, duplicate_detections, negative_images_with_fp, negative_fp_detections]) AS recomputed FROM p""")
def sweep_recheck(spark: SparkSession, folder: str) -> DataFrame:
    """The sweep's row of the selected point against a computation by other operators; a difference would raise."""
    pred, truth = (materialize(d, "boxes") for d in _data(spark, folder))
    return det.check_point(det.sweep(pred, truth, CONFIDENCES, SUPPRESSIONS), pred, truth, 0.225, 0.45)


def _points(spark: SparkSession, folder: str) -> DataFrame:
    pred, truth = _data(spark, folder)
    truth = materialize(truth, "truth")
    images = table(spark, folder, "orders").select(F.col("o_orderkey").alias("image_id"))
    rows = det.outcomes(pred.where("score >= 0.175"), truth)
    return det.outcome_points(rows, truth, images, {"r": 0.175, "b": 0.225, "f": 0.375})


def _category_sql() -> str:
    parts = [_BASE]
    for p, c in (("r", 0.175), ("b", 0.225), ("f", 0.375)):
        parts.append(_outcome(c).replace("out AS", f"out_{p} AS"))
        parts.append(
            f"i_{p} AS (SELECT o.o_orderkey AS image_id, coalesce(list_sort(list(DISTINCT x.gt_index) FILTER (x.outcome = 'tp')), []) AS matched, count(x.pred_index) FILTER (x.outcome IN ('fp', 'duplicate')) AS n_false "
            f"FROM orders o LEFT JOIN out_{p} x ON x.image_id = o.o_orderkey GROUP BY 1)"
        )
    parts.append("t AS (SELECT image_id, list_sort(list(gt_index)) AS g FROM gt GROUP BY 1)")
    parts.append(
        """j AS (SELECT r.image_id, len(coalesce(t.g, [])) AS n, len(coalesce(t.g, [])) - len(r.matched) AS rm, len(coalesce(t.g, [])) - len(b.matched) AS bm, len(coalesce(t.g, [])) - len(f.matched) AS fm, r.n_false AS rf, b.n_false AS bf, f.n_false AS ff,
  list_filter(r.matched, lambda x: NOT list_contains(f.matched, x)) AS rec, list_filter(b.matched, lambda x: NOT list_contains(f.matched, x)) AS recb FROM i_r r JOIN i_b b USING (image_id) JOIN i_f f USING (image_id) LEFT JOIN t USING (image_id))"""
    )
    tags = """array_to_string(list_sort(list_filter([CASE WHEN len(rec) > 0 THEN 'recovered_recall' END, CASE WHEN len(recb) > 0 THEN 'recovered_balanced' END, CASE WHEN rm > 0 THEN 'persistent_fn' END, CASE WHEN n > 0 AND bf > ff THEN 'extra_fp_balanced' END,
  CASE WHEN n = 0 AND rf > 0 THEN 'negative_fp' END, CASE WHEN n >= 2 AND rm + bm + fm + rf + bf + ff > 0 THEN 'multi_plate_error' END], lambda e: e IS NOT NULL)), '|')"""
    return f"WITH {', '.join(parts)} SELECT * FROM (SELECT image_id, {tags} AS categories, array_to_string(list_sort(rec), '|') AS recovered FROM j) WHERE categories <> ''"


@BOOK.query(_category_sql())
def error_categories(spark: SparkSession, folder: str) -> DataFrame:
    return det.review_manifest(det.categorize(_points(spark, folder)))


_AP = f"""WITH RECURSIVE {_BASE}, lv AS (SELECT unnest([0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95])::DOUBLE AS level),
cand AS (SELECT image_id, pred_index, list({{'o': i / greatest(pa + ga - i, 1e-9), 'g': -gt_index}} ORDER BY i / greatest(pa + ga - i, 1e-9) DESC, gt_index) FILTER (gt_index IS NOT NULL) AS c FROM o GROUP BY 1, 2),
ranked AS (SELECT p.image_id, p.score, coalesce(c.c, []) AS c, row_number() OVER (PARTITION BY p.image_id ORDER BY p.score DESC, p.pred_index) AS r FROM pred p JOIN cand c USING (image_id, pred_index)),
top AS (SELECT * FROM ranked WHERE r <= 100),
walk AS (SELECT level, image_id, r, score, got, CASE WHEN got IS NULL THEN [] ELSE [got] END AS used FROM (SELECT l.level, t.image_id, t.r, t.score, list_filter(t.c, lambda x: x.o >= l.level)[1].g AS got FROM top t, lv l WHERE t.r = 1)
  UNION ALL SELECT level, image_id, r, score, got, CASE WHEN got IS NULL THEN used ELSE list_append(used, got) END FROM (
    SELECT w.level, t.image_id, t.r, t.score, list_filter(t.c, lambda x: x.o >= w.level AND NOT list_contains(w.used, x.g))[1].g AS got, w.used FROM walk w JOIN top t ON t.image_id = w.image_id AND t.r = w.r + 1)),
steps AS (SELECT level, score, count(*) AS n, count(got) AS t FROM walk GROUP BY 1, 2),
curve AS (SELECT level, sum(t) OVER w / sum(n) OVER w AS precision, sum(t) OVER w / (SELECT count(*) FROM gt) AS recall FROM steps WINDOW w AS (PARTITION BY level ORDER BY score DESC))
SELECT level AS iou_level, round(avg(best), 9) AS ap FROM (SELECT l.level, i, coalesce(max(precision), 0) AS best FROM lv l CROSS JOIN range(101) g(i) LEFT JOIN curve c ON c.level = l.level AND floor(c.recall * 100 + 1e-9) >= i GROUP BY 1, 2) GROUP BY 1"""


@BOOK.query(_AP)
def average_precision(spark: SparkSession, folder: str) -> DataFrame:
    return det.average_precision(*_data(spark, folder)).withColumn("ap", F.round("ap", 9))


@BOOK.query(f"""{_SWEEP}, w AS (SELECT * FROM sweep WHERE nms_threshold = 0.45)
SELECT w.confidence_threshold, w.tp - b.tp AS tp_delta, w.fp - b.fp AS fp_delta, w.fn - b.fn AS fn_delta, round(w.f1 - b.f1, 6) AS f1_delta FROM w, (SELECT * FROM w WHERE confidence_threshold = 0.225) b""")
def operating_deltas(spark: SparkSession, folder: str) -> DataFrame:
    rows = threshold_sweep(spark, folder).where("nms_threshold = 0.45")
    return det.operating_deltas(rows, "confidence_threshold", 0.225, ["tp", "fp", "fn", "f1"]).withColumn("f1_delta", F.round("f1_delta", 6))


@BOOK.query(f"""WITH {_BASE}, other AS (SELECT image_id, pred_index, x1, y1, x2 + (image_id % 5) / 1000.0::DOUBLE AS x2, y2, score - (pred_index % 4) / 400.0::DOUBLE AS score FROM pred WHERE NOT (image_id % 7 = 0 AND pred_index = 1)),
a AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, pred_index) AS r FROM pred), b AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, pred_index) AS r FROM other),
j AS (SELECT a.score AS s, b.score AS z, greatest(abs(a.x1 - b.x1), abs(a.y1 - b.y1), abs(a.x2 - b.x2), abs(a.y2 - b.y2)) AS d,
  coalesce(abs(a.x1 - b.x1) <= 1e-3 + 1e-3 * abs(b.x1) AND abs(a.y1 - b.y1) <= 1e-3 + 1e-3 * abs(b.y1) AND abs(a.x2 - b.x2) <= 1e-3 + 1e-3 * abs(b.x2) AND abs(a.y2 - b.y2) <= 1e-3 + 1e-3 * abs(b.y2) AND abs(a.score - b.score) <= 1e-3 + 1e-3 * abs(b.score), false) AS good
  FROM a FULL OUTER JOIN b ON a.image_id = b.image_id AND a.r = b.r)
SELECT count(*) AS rows, count(*) FILTER (s IS NULL OR z IS NULL) AS unmatched, round(max(CASE WHEN s IS NOT NULL AND z IS NOT NULL THEN d END), 9) AS max_box_diff, round(max(abs(s - z)), 9) AS max_score_diff, bool_and(good) AS all_close FROM j
""")
def compare_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs that differ in boxes, scores, their order within images, and missing boxes."""
    pred, _ = _data(spark, folder)
    other = pred.withColumns({"x2": F.col("x2") + (F.col("image_id") % 5) / 1000.0, "score": F.col("score") - (F.col("pred_index") % 4) / 400.0}).where("not (image_id % 7 = 0 and pred_index = 1)")
    return det.compare_predictions(pred, other).withColumns({c: F.round(c, 9) for c in ("max_box_diff", "max_score_diff")})


@BOOK.query(f"WITH {_BASE} SELECT CASE WHEN count(DISTINCT image_id) > 0 THEN round(sum(w * h / 100) / sum(1), 9) ELSE 0 END AS ms_per_image FROM base")
def mean_time(spark: SparkSession, folder: str) -> DataFrame:
    """Milliseconds an image, of a log with one line a batch (here each line stands for one image)."""
    pred, _ = _data(spark, folder)
    log = pred.select(((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) / 100).alias("ms"), F.lit(1).alias("images"))
    return det.mean_time(log, "ms", "images").withColumn("ms_per_image", F.round("ms_per_image", 9))
