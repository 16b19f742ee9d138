"""Detection evaluation: suppression, matching, sweeps, error categories, average precision.

Predictions are rows ``image_id, pred_index, x1, y1, x2, y2, score`` and ground truth rows
``image_id, gt_index, x1, y1, x2, y2``. All work is within an image, so every step is an
equi-join or an aggregation on ``image_id``; the number of boxes of one image is bounded
by the detector's output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions.geometry import centre_to_xyxy, iou

IOU_MATCH = 0.5
CORNERS = ("x1", "y1", "x2", "y2")


def _box(row: Column | str, prefix: str = "") -> tuple[Column, ...]:
    if isinstance(row, str):
        return tuple(F.col(f"{row}{c}") for c in CORNERS)
    return tuple(row[c] for c in CORNERS)


def decode(raw: DataFrame, confidence: float, scale: Column | None = None) -> DataFrame:
    """Raw centre boxes with ``objectness`` and ``class_conf`` as scored corners; boxes under the confidence are left out.

    ``scale`` is the letterbox scale, by which corners are divided.
    """
    by = F.lit(1.0) if scale is None else scale
    score = F.col("objectness") * F.col("class_conf")
    corners = centre_to_xyxy(*(F.col(c) for c in ("cx", "cy", "w", "h")))
    return raw.withColumn("score", score).where(F.col("score") >= confidence).select("image_id", "pred_index", *((v / by).alias(n) for n, v in zip(CORNERS, corners)), "score")


def suppress(predictions: DataFrame, threshold: float | Column) -> DataFrame:
    """Greedy non-maximum suppression within each image.

    In the order of falling score (ties by ``pred_index``) a box is kept unless it
    overlaps a kept box by more than the threshold. The fold over the boxes of an image
    is an array expression; images are independent.
    """
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    boxes = predictions.groupBy("image_id").agg(F.collect_list(F.struct((-F.col("score")).alias("_o"), "pred_index", *CORNERS, "score")).alias("b"))
    boxes = boxes.withColumn("b", F.array_sort("b"))
    empty = F.filter("b", lambda x: F.lit(False))
    kept = F.aggregate("b", empty, lambda acc, x: F.when(F.exists(acc, lambda k: iou(_box(k), _box(x)) > limit), acc).otherwise(F.concat(acc, F.array(x))))
    return boxes.select("image_id", F.explode(kept).alias("p")).select("image_id", "p.pred_index", *(f"p.{c}" for c in CORNERS), "p.score")


def best_overlaps(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Each prediction with the ground truth of its image that it overlaps most (``gt_index, overlap``; nulls if there is none).

    Of equal overlaps the smallest ``gt_index`` counts. Further key columns of the
    predictions (thresholds) are kept.
    """
    keys = [c for c in predictions.columns if c not in CORNERS]
    gt = truth.select("image_id", "gt_index", *(F.col(c).alias(f"g_{c}") for c in CORNERS))
    pairs = predictions.join(gt, "image_id", "left").withColumn("overlap", iou(_box(""), _box("g_")))
    return pairs.groupBy(*keys).agg(F.max_by("gt_index", F.struct("overlap", -F.col("gt_index"))).alias("gt_index"), F.max("overlap").alias("overlap"))


def outcomes(predictions: DataFrame, truth: DataFrame, by: list[str] = (), least: float = IOU_MATCH) -> DataFrame:
    """Each prediction with ``outcome`` tp, duplicate or fp.

    A prediction looks only at the ground truth it overlaps most. Under ``least`` it is
    false; of the predictions for one ground truth the best score (ties by
    ``pred_index``) is true and the others are duplicates, which also count as false.
    """
    best = best_overlaps(predictions, truth)
    hit = F.coalesce(F.col("overlap") >= least, F.lit(False))
    w = Window.partitionBy(*by, "image_id", F.when(hit, F.col("gt_index"))).orderBy(F.desc("score"), "pred_index")
    return best.withColumn("outcome", F.when(~hit, "fp").when(F.row_number().over(w) == 1, "tp").otherwise("duplicate"))


def metrics(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """Precision, recall and F1, each 0 where its denominator is."""
    safe = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    precision, recall = safe(tp, tp + fp), safe(tp, tp + fn)
    return [precision.alias("precision"), recall.alias("recall"), safe(2 * precision * recall, precision + recall).alias("f1")]


def match_counts(predictions: DataFrame, truth: DataFrame, by: list[str] = (), least: float = IOU_MATCH) -> DataFrame:
    """tp, fp, fn, precision, recall, f1, duplicates and the false detections on images without ground truth.

    One row, or one for each combination of the ``by`` columns of the predictions.
    """
    rows = outcomes(predictions, truth, list(by), least)
    known = truth.select("image_id").distinct().withColumn("_known", F.lit(True))
    rows = rows.join(known, "image_id", "left")
    false, negative = F.col("outcome") != "tp", F.col("_known").isNull()
    agg = rows.groupBy(*by).agg(
        F.count_if(~false).alias("tp"),
        F.count_if(false).alias("fp"),
        F.count_if(F.col("outcome") == "duplicate").alias("duplicate_detections"),
        F.count_distinct(F.when(negative & false, F.col("image_id"))).alias("negative_images_with_fp"),
        F.count_if(negative & false).alias("negative_fp_detections"),
    )
    total = truth.agg(F.count(F.lit(1)).alias("truths"))  # one row
    agg = agg.crossJoin(F.broadcast(total)).withColumn("fn", F.col("truths") - F.col("tp"))
    tp, fp, fn = map(F.col, ("tp", "fp", "fn"))
    return agg.select(*by, tp, fp, fn, *metrics(tp, fp, fn), "duplicate_detections", "negative_images_with_fp", "negative_fp_detections")


def _image_arrays(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """``image_id, b, known``: the boxes of each image by falling score, each with the truth it overlaps most as ``best`` (overlap ``o``, ``i`` = -gt_index)."""
    b = predictions.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "pred_index", *CORNERS))).alias("b"))
    g = truth.groupBy("image_id").agg(F.collect_list(F.struct("gt_index", *CORNERS)).alias("g"))
    best = lambda x: F.array_max(F.transform("g", lambda y: F.struct(iou(_box(x), _box(y)).alias("o"), (-y["gt_index"]).cast("int").alias("i"))))
    rows = b.join(g, "image_id", "left")
    return rows.select("image_id", F.transform("b", lambda x: F.struct(x["down"].alias("down"), *(x[c].alias(c) for c in CORNERS), best(x).alias("best"))).alias("b"), F.col("g").isNotNull().alias("known"))


def _suppressed_outcomes(boxes: str, threshold: float, least: float) -> Column:
    """Array of ``down, outcome, first`` of the boxes that suppression keeps; ``first`` marks the first false one."""
    start = F.struct(
        F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>").alias("kept"),
        F.array().cast("array<int>").alias("used"),
        F.array().cast("array<struct<down:double,outcome:string,first:boolean>>").alias("out"),
        F.lit(False).alias("false"),
    )

    def turn(acc: Column, x: Column) -> Column:
        hit = F.coalesce(x["best"]["o"] >= least, F.lit(False))
        outcome = F.when(~hit, "fp").when(F.array_contains(acc["used"], x["best"]["i"]), "duplicate").otherwise("tp")
        step = F.struct(
            F.concat(acc["kept"], F.array(F.struct(*(x[c].alias(c) for c in CORNERS)))).alias("kept"),
            F.when(hit, F.concat(acc["used"], F.array(x["best"]["i"]))).otherwise(acc["used"]).alias("used"),
            F.concat(acc["out"], F.array(F.struct(x["down"].alias("down"), outcome.alias("outcome"), ((outcome != "tp") & ~acc["false"]).alias("first")))).alias("out"),
            (acc["false"] | (outcome != "tp")).alias("false"),
        )
        return F.when(F.exists(acc["kept"], lambda k: iou(_box(k), _box(x)) > threshold), acc).otherwise(step)

    return F.aggregate(boxes, start, turn)["out"]


def sweep(predictions: DataFrame, truth: DataFrame, confidences: list[float], suppressions: list[float], least: float = IOU_MATCH) -> DataFrame:
    """``match_counts`` for each pair of confidence and suppression threshold.

    A box of a lower score never suppresses one of a higher, so the boxes of an image are
    gathered once, suppressed and matched in one fold for each suppression threshold at
    the lowest confidence, and the confidences only cut the scored outcomes. Best overlaps
    don't depend on the confidence; whether a box is true or a duplicate doesn't either,
    as only better boxes come before it. Outcomes are counted between one confidence and
    the next and added up over this small table. Combinations without a detection have
    zero counts.
    """
    spark, cuts = predictions.sparkSession, sorted(set(map(float, confidences)))
    images = _image_arrays(predictions.where(F.col("score") >= cuts[0]), truth)
    folds = F.array(*(F.struct(F.lit(float(t)).alias("nms_threshold"), _suppressed_outcomes("b", float(t), least).alias("out")) for t in suppressions))
    rows = images.select("known", F.explode(folds).alias("f")).select("known", "f.nms_threshold", F.explode("f.out").alias("o"))
    false, negative = F.col("o.outcome") != "tp", ~F.col("known")
    level = sum(((-F.col("o.down") >= c).cast("int") for c in cuts), F.lit(0))  # how many confidences the score reaches
    counts = {
        "tp": F.count_if(~false), "fp": F.count_if(false), "duplicate_detections": F.count_if(F.col("o.outcome") == "duplicate"),
        "negative_images_with_fp": F.count_if(negative & F.col("o.first")), "negative_fp_detections": F.count_if(negative & false),
    }
    per = rows.groupBy("nms_threshold", level.alias("level")).agg(*(c.alias(n) for n, c in counts.items()))  # a row for each pair at most
    grid = spark.createDataFrame([(float(c), float(t), cuts.index(float(c)) + 1) for t in suppressions for c in confidences], "confidence_threshold double, nms_threshold double, at int")
    agg = F.broadcast(grid).join(per, (grid["nms_threshold"] == per["nms_threshold"]) & (per["level"] >= grid["at"]), "left").groupBy("confidence_threshold", grid["nms_threshold"])
    agg = agg.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts))
    agg = agg.crossJoin(F.broadcast(truth.agg(F.count(F.lit(1)).alias("truths")))).withColumn("fn", F.col("truths") - F.col("tp"))
    tp, fp, fn = map(F.col, ("tp", "fp", "fn"))
    return agg.select(
        "confidence_threshold", "nms_threshold", F.lit(float(least)).alias("match_iou_threshold"), tp, fp, fn, *metrics(tp, fp, fn),
        "duplicate_detections", "negative_images_with_fp", "negative_fp_detections",
    )


def check_point(rows: DataFrame, predictions: DataFrame, truth: DataFrame, confidence: float, suppression: float, least: float = IOU_MATCH) -> DataFrame:
    """One row of a sweep computed again from the boxes, by a join and a window instead of the fold; a difference raises.

    Returns ``confidence_threshold, nms_threshold, measure, swept, recomputed``.
    """
    from curatrix.contracts import ContractError

    names = ["tp", "fp", "fn", "duplicate_detections", "negative_images_with_fp", "negative_fp_detections"]
    again = match_counts(suppress(predictions.where(F.col("score") >= confidence), suppression), truth, least=least)
    pair = rows.where((F.col("confidence_threshold") == confidence) & (F.col("nms_threshold") == suppression))
    lines = lambda df, n: df.select(F.explode(F.create_map(*(x for m in names for x in (F.lit(m), F.col(m).cast("long"))))).alias("measure", n))
    out = lines(pair, "swept").join(lines(again, "recomputed"), "measure", "full_outer")
    if bad := out.where(~F.col("swept").eqNullSafe(F.col("recomputed"))).limit(10).collect():
        raise ContractError(f"sweep (measure, swept, recomputed): {[tuple(b) for b in bad]}")
    return out.select(F.lit(float(confidence)).alias("confidence_threshold"), F.lit(float(suppression)).alias("nms_threshold"), "measure", "swept", "recomputed")


def best_point(rows: DataFrame) -> DataFrame:
    """The row of the best F1; of equal ones the smallest suppression threshold, then the smallest confidence."""
    return rows.orderBy(F.desc("f1"), "nms_threshold", "confidence_threshold").limit(1)


def image_outcomes(predictions: DataFrame, truth: DataFrame, images: DataFrame, least: float = IOU_MATCH) -> DataFrame:
    """For every image: sorted arrays ``matched`` and ``missed`` (gt_index) and ``false_pred`` (pred_index)."""
    return collect_outcomes(outcomes(predictions, truth, [], least), truth, images)


def collect_outcomes(rows: DataFrame, truth: DataFrame, images: DataFrame) -> DataFrame:
    """``image_outcomes`` of rows with their outcome."""
    points = outcome_points(rows, truth, images, {"x": float("-inf")})
    return points.select("image_id", "truths", *(F.col(f"x_{c}").alias(c) for c in ("matched", "false_pred", "missed")))


def outcome_points(rows: DataFrame, truth: DataFrame, images: DataFrame, confidences: dict[str, float]) -> DataFrame:
    """For every image ``truths`` and, for each named confidence, ``<name>_matched``, ``<name>_false_pred`` and ``<name>_missed``.

    Only better boxes of an image decide whether a box is true or a duplicate, so the
    outcomes at a higher confidence are those at a lower one, cut by score: all points
    come from one aggregation.
    """
    cut = lambda c, when: F.array_sort(F.collect_set(F.when((F.col("score") >= c) & when[0], F.col(when[1]))))
    tp, fp = (F.col("outcome") == "tp", "gt_index"), (F.col("outcome") != "tp", "pred_index")
    hits = rows.groupBy("image_id").agg(*(cut(c, k).alias(f"{n}_{name}") for n, c in confidences.items() for k, name in ((tp, "matched"), (fp, "false_pred"))))
    gts = truth.groupBy("image_id").agg(F.array_sort(F.collect_set("gt_index")).alias("truths"))
    out = images.select("image_id").distinct().join(gts, "image_id", "left").join(hits, "image_id", "left")
    none = F.array().cast("array<int>")
    fill = lambda c: F.coalesce(F.col(c).cast("array<int>"), none).alias(c)
    out = out.select("image_id", fill("truths"), *(fill(f"{n}_{c}") for n in confidences for c in ("matched", "false_pred")))
    return out.withColumns({f"{n}_missed": F.array_except("truths", f"{n}_matched") for n in confidences})


def error_categories(recall: DataFrame, balanced: DataFrame, f1: DataFrame, names: tuple[str, ...] | None = None) -> DataFrame:
    """``categorize`` of three ``image_outcomes``, joined by image."""
    a, b, c = (d.select("image_id", *(F.col(x).alias(f"{p}_{x}") for x in ("truths", "matched", "missed", "false_pred"))) for p, d in (("r", recall), ("b", balanced), ("f", f1)))
    return categorize(a.join(b, "image_id").join(c, "image_id").withColumn("truths", F.col("r_truths")), names)


def categorize(rows: DataFrame, names: tuple[str, ...] | None = None) -> DataFrame:
    """``image_id, categories, recovered``: images with an error at three operating points, of ``outcome_points`` named r, b and f.

    Categories: found at the recall point but not at the F1 point; found at the balanced
    but not at the F1 point; missed even at the recall point; more false detections at
    the balanced than at the F1 point on an image with truth; a false detection on an
    image without; any error on an image with two truths or more. Images without a
    category are left out.
    """
    names = names or ("recovered_recall", "recovered_balanced", "persistent_fn", "extra_fp_balanced", "negative_fp", "multi_plate_error")
    n = lambda x: F.size(x)
    any_error = sum((n(f"{p}_{x}") for p in "rbf" for x in ("missed", "false_pred")), F.lit(0)) > 0
    recovered = F.array_except("r_matched", "f_matched")
    rules = [
        n(recovered) > 0,
        n(F.array_except("b_matched", "f_matched")) > 0,
        n("r_missed") > 0,
        (n("truths") > 0) & (n("b_false_pred") > n("f_false_pred")),
        (n("truths") == 0) & (n("r_false_pred") > 0),
        (n("truths") >= 2) & any_error,
    ]
    tags = F.array_compact(F.array(*(F.when(r, F.lit(x)) for r, x in zip(rules, names))))
    return rows.select("image_id", tags.alias("categories"), F.array_sort(recovered).alias("recovered")).where(F.size("categories") > 0)


def review_manifest(categories: DataFrame) -> DataFrame:
    """The error categories with their lists joined by ``|``, sorted."""
    return categories.select("image_id", F.array_join(F.array_sort("categories"), "|").alias("categories"), F.array_join(F.transform("recovered", lambda x: x.cast("string")), "|").alias("recovered"))


def average_precision(predictions: DataFrame, truth: DataFrame, levels: list[float] | None = None, most: int = 100) -> DataFrame:
    """``iou_level, ap`` of one class by the COCO protocol: 101 recall points of the running-maximum precision.

    Within an image the best ``most`` boxes, by falling score, each take the free ground
    truth they overlap most (at least the level); only overlapping pairs enter the fold.
    Detections are then counted by score, and true ones are summed up over falling scores
    by a distributed sort, not in one window; equal scores are one step of the curve. A
    level without truth has null.
    """
    from curatrix.operators.ranks import global_positions

    levels = levels or [round(0.5 + 0.05 * i, 2) for i in range(10)]
    top = predictions.withColumn("_r", F.row_number().over(Window.partitionBy("image_id").orderBy(F.desc("score"), "pred_index"))).where(F.col("_r") <= most)
    gt = truth.select("image_id", "gt_index", *(F.col(c).alias(f"g_{c}") for c in CORNERS))
    near = top.join(gt, "image_id").withColumn("o", iou(_box(""), _box("g_"))).where(F.col("o") >= min(levels))
    near = near.groupBy("image_id", "pred_index", "score").agg(F.collect_list(F.struct("o", (-F.col("gt_index")).cast("int").alias("i"))).alias("c"))
    images = near.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "pred_index", "c"))).alias("b"))
    images = images.withColumn("level", F.explode(F.array(*(F.lit(float(x)) for x in levels))))
    start = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast("array<double>").alias("hits"))

    def turn(acc: Column, p: Column) -> Column:
        best = F.array_max(F.filter(p["c"], lambda x: (x["o"] >= F.col("level")) & ~F.array_contains(acc["used"], x["i"])))
        return F.when(best.isNull(), acc).otherwise(F.struct(F.concat(acc["used"], F.array(best["i"])).alias("used"), F.concat(acc["hits"], F.array(p["down"])).alias("hits")))

    hits = images.select("level", F.explode(F.aggregate("b", start, turn)["hits"]).alias("down")).groupBy("down").agg(*(F.count_if(F.col("level") == float(x)).alias(f"t{k}") for k, x in enumerate(levels)))
    sizes = top.groupBy((-F.col("score")).alias("down")).agg(F.count(F.lit(1)).alias("n"))
    steps = sizes.join(hits, "down", "left").na.fill(0)  # one row a score, a counter for each level
    sums = {"p": "n"} | {f"c{k}": f"t{k}" for k in range(len(levels))}
    ranked = global_positions(steps, ["down"], weight=sums)
    total = truth.agg(F.count(F.lit(1)).alias("truths"))
    seen = F.col("p") + F.col("n")
    lines = F.explode(F.array(*(F.struct(F.lit(float(x)).alias("level"), (F.col(f"c{k}") + F.col(f"t{k}")).alias("hits")) for k, x in enumerate(levels)))).alias("l")
    curve = ranked.select(seen.alias("seen"), lines).crossJoin(F.broadcast(total)).select("l.level", (F.col("l.hits") / F.col("seen")).alias("precision"), F.try_divide("l.hits", "truths").alias("recall"))
    # precision at recall point i / 100 is the best precision at that recall or beyond
    point = F.floor(F.col("recall") * 100 + 1e-9).cast("int")
    peaks = curve.where("recall is not null").groupBy("level", point.alias("point")).agg(F.max("precision").alias("precision"))  # 101 rows a level
    grid = truth.sparkSession.createDataFrame([(float(x), i) for x in levels for i in range(101)], "level double, i int")
    at = F.broadcast(grid).join(F.broadcast(peaks), "level", "left").where("point is null or point >= i").groupBy("level", "i").agg(F.max("precision").alias("p"))
    per = at.groupBy("level").agg((F.sum(F.coalesce("p", F.lit(0.0))) / 101).alias("ap"))
    levels_df = truth.sparkSession.createDataFrame([(float(x),) for x in levels], "level double")
    return levels_df.join(per, "level", "left").crossJoin(F.broadcast(total)).select(F.col("level").alias("iou_level"), F.when(F.col("truths") > 0, F.coalesce("ap", F.lit(0.0))).alias("ap"))


def operating_deltas(rows: DataFrame, key: str, base: object, measures: list[str]) -> DataFrame:
    """Each operating point's measures less those of the base point."""
    ref = rows.where(F.col(key) == base).select(*(F.col(m).alias(f"_{m}") for m in measures))
    return rows.crossJoin(F.broadcast(ref)).select(key, *((F.col(m) - F.col(f"_{m}")).alias(f"{m}_delta") for m in measures))  # one row


def compare_predictions(a: DataFrame, b: DataFrame, relative: float = 1e-3, absolute: float = 1e-3) -> DataFrame:
    """Two prediction sets joined by image and rank of score: rows, unmatched rows, largest box and score difference, ``all_close``."""
    w = Window.partitionBy("image_id").orderBy(F.desc("score"), "pred_index")
    x, y = (d.withColumn("rank", F.row_number().over(w)).select("image_id", "rank", *(F.col(c).alias(f"{p}{c}") for c in (*CORNERS, "score"))) for p, d in (("a_", a), ("b_", b)))
    both = x.join(y, ["image_id", "rank"], "full_outer")
    cols = (*CORNERS, "score")
    close = lambda c: F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) <= absolute + relative * F.abs(F.col(f"b_{c}"))
    box = F.greatest(*(F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) for c in CORNERS))
    good = F.lit(True)
    for c in cols:
        good = good & F.coalesce(close(c), F.lit(False))
    return both.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("a_score").isNull() | F.col("b_score").isNull()).alias("unmatched"),
        F.max(box).alias("max_box_diff"), F.max(F.abs(F.col("a_score") - F.col("b_score"))).alias("max_score_diff"), F.coalesce(F.min(good), F.lit(True)).alias("all_close"),
    )


def mean_time(df: DataFrame, milliseconds: str, images: str) -> DataFrame:
    """One row: mean milliseconds an image, 0 without images."""
    return df.agg(F.coalesce(F.try_divide(F.sum(milliseconds), F.sum(images)), F.lit(0.0)).alias("ms_per_image"))
