import random

import pytest
from pyspark.sql import functions as F

from curatrix.evaluate import detection as det
from curatrix.evaluate import ocr

PRED = "image_id long, pred_index int, x1 double, y1 double, x2 double, y2 double, score double"
GT = "image_id long, gt_index int, x1 double, y1 double, x2 double, y2 double"


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    i = max(w, 0) * max(h, 0)
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    return i / max(area(a) + area(b) - i, 1e-9)


@pytest.fixture(scope="module")
def data():
    r = random.Random(11)
    pred, gt = [], []
    for image in range(40):
        boxes = [(r.randint(0, 60), r.randint(0, 40), r.randint(20, 40), r.randint(10, 30)) for _ in range(r.randint(0, 4))]
        for g, (x, y, w, h) in enumerate(boxes):
            gt.append((image, g, float(x), float(y), float(x + w), float(y + h)))
            for _ in range(r.randint(0, 3)):
                dx, dy = r.randint(-6, 6), r.randint(-4, 4)
                pred.append((image, float(x + dx), float(y + dy), float(x + w + dx), float(y + h), round(r.random(), 2)))
        if r.random() < 0.4:
            pred.append((image, 200.0, 200.0, 220.0, 215.0, round(r.random(), 2)))
    count = {}
    out = []
    for p in pred:
        k = count.get(p[0], 0)
        count[p[0]] = k + 1
        out.append((p[0], k, *p[1:]))
    return out, gt


def brute_nms(pred, t):
    out = []
    for image in {p[0] for p in pred}:
        kept = []
        for p in sorted((p for p in pred if p[0] == image), key=lambda p: (-p[6], p[1])):
            if all(iou(p[2:6], k[2:6]) <= t for k in kept):
                kept.append(p)
        out += kept
    return out


def brute_match(pred, gt):
    tp = fp = dup = 0
    seen = set()
    for p in sorted(pred, key=lambda p: (p[0], -p[6], p[1])):
        best = max(((iou(p[2:6], g[2:6]), -g[1]) for g in gt if g[0] == p[0]), default=(0, 0))
        if best[0] < 0.5:
            fp += 1
        elif (p[0], best[1]) in seen:
            fp, dup = fp + 1, dup + 1
        else:
            seen.add((p[0], best[1]))
            tp += 1
    return tp, fp, len(gt) - tp, dup


def test_contract_fixture(spark):
    raw = spark.createDataFrame([(1, 0, 100.0, 100.0, 40.0, 20.0, 0.5, 0.5), (1, 1, 102.0, 100.0, 40.0, 20.0, 0.4, 0.6), (1, 2, 300.0, 300.0, 20.0, 10.0, 0.2, 0.9)], "image_id long, pred_index int, cx double, cy double, w double, h double, objectness double, class_conf double")
    kept = det.suppress(det.decode(raw, 0.225), 0.45).collect()
    assert [tuple(r)[2:] for r in kept] == [(80.0, 90.0, 120.0, 110.0, 0.25)]


def test_suppress_sweep_and_counts(spark, data):
    pred, gt = (spark.createDataFrame(rows, s) for rows, s in zip(data, (PRED, GT)))
    for t in (0.4, 0.55):
        assert {(r[0], r[1]) for r in det.suppress(pred, t).collect()} == {(p[0], p[1]) for p in brute_nms(data[0], t)}
    got = {(r["confidence_threshold"], r["nms_threshold"]): r for r in det.sweep(pred, gt, [0.1, 0.4, 0.99], [0.4, 0.55]).collect()}
    assert len(got) == 6
    for (c, t), r in got.items():
        want = brute_match(brute_nms([p for p in data[0] if p[6] >= c], t), data[1])
        assert (r["tp"], r["fp"], r["fn"], r["duplicate_detections"]) == want
    row = det.match_counts(pred, gt).first()
    assert (row["tp"], row["fp"], row["fn"], row["duplicate_detections"]) == brute_match(*data)
    best = det.best_point(spark.createDataFrame([(0.2, 0.5, 0.9), (0.1, 0.5, 0.9), (0.3, 0.4, 0.9)], "confidence_threshold double, nms_threshold double, f1 double")).first()
    assert best[0] == 0.3


def test_matching_fixtures(spark):
    gt = spark.createDataFrame([(1, 0, 0.0, 0.0, 10.0, 10.0), (1, 1, 4.0, 0.0, 14.0, 10.0), (2, 0, 0.0, 0.0, 10.0, 10.0)], GT)
    # both look at truth 0 although the second also overlaps truth 1
    pred = spark.createDataFrame([(1, 0, 0.0, 0.0, 10.0, 10.0, 0.9), (1, 1, 1.0, 0.0, 11.0, 10.0, 0.8), (3, 0, 0.0, 0.0, 1.0, 1.0, 0.7)], PRED)
    r = det.match_counts(pred, gt).first()
    assert (r["tp"], r["fp"], r["fn"], r["duplicate_detections"], r["negative_images_with_fp"], r["negative_fp_detections"]) == (1, 2, 2, 1, 1, 1)
    edge = spark.createDataFrame([(2, 0, 0.0, 0.0, 10.0, 5.0, 0.9)], PRED)  # overlap exactly one half
    assert det.match_counts(edge, gt.where("image_id = 2")).first()["tp"] == 1
    none = det.match_counts(pred.where("false"), gt).first()
    assert (none["tp"], none["fp"], none["fn"], none["f1"]) == (0, 0, 3, 0.0)
    empty = det.match_counts(pred, gt.where("false")).first()
    assert (empty["tp"], empty["fp"], empty["fn"], empty["precision"]) == (0, 3, 0, 0.0)
    images = spark.createDataFrame([(1,), (2,), (3,), (4,)], "image_id long")
    state = {r["image_id"]: (r["matched"], r["missed"], r["false_pred"]) for r in det.image_outcomes(pred, gt, images).collect()}
    assert state == {1: ([0], [1], [1]), 2: ([], [0], []), 3: ([], [], [0]), 4: ([], [], [])}


def test_metric_numbers(spark):
    row = spark.range(1).select(*det.metrics(F.lit(747), F.lit(159), F.lit(167))).first()
    assert [round(x, 6) for x in row] == [0.824503, 0.817287, 0.820879]


def brute_ap(pred, gt, level):
    ranked, used, flags = sorted(pred, key=lambda p: -p[6]), set(), {}
    for image in {p[0] for p in pred}:
        for p in sorted((p for p in pred if p[0] == image), key=lambda p: (-p[6], p[1])):
            best = max(((iou(p[2:6], g[2:6]), -g[1]) for g in gt if g[0] == image and (image, g[1]) not in used), default=(0, 0))
            flags[p[0], p[1]] = best[0] >= level
            if best[0] >= level:
                used.add((image, -best[1]))
    points, tp, n, k = [], 0, 0, 0
    while k < len(ranked):
        score = ranked[k][6]
        while k < len(ranked) and ranked[k][6] == score:
            tp, n, k = tp + flags[ranked[k][0], ranked[k][1]], n + 1, k + 1
        points.append((tp / len(gt), tp / n))
    assert n == len(ranked)
    return sum(max((p for r, p in points if r >= i / 100 - 1e-12), default=0) for i in range(101)) / 101


def test_average_precision(spark, data):
    pred, gt = (spark.createDataFrame(rows, s) for rows, s in zip(data, (PRED, GT)))
    for r in det.average_precision(pred, gt, [0.5, 0.75]).collect():
        assert r["ap"] == pytest.approx(brute_ap(*data, r["iou_level"]), abs=1e-9)
    assert det.average_precision(pred, gt.where("false"), [0.5]).first()["ap"] is None
    assert det.average_precision(pred.where("false"), gt, [0.5]).first()["ap"] == 0.0


def test_recognition(spark):
    df = spark.createDataFrame([("NME07592", "NMEO7592", "a; b"), ("BOIXEN", "B01XEN", "b"), ("AB12", "AB-12", ""), ("X", None, None)], "t string, r string, n string")
    s = ocr.with_distance(df, "t", "r")
    assert [r["edit_distance"] for r in s.collect()] == [1, 2, 0, 1]
    total = ocr.summary(s).first()
    assert (total["row_count"], total["exact_count"], total["edit_distance"], total["characters"], total["empty_count"]) == (4, 1, 4, 19, 1)
    assert {tuple(r) for r in ocr.slice_accuracy(s, "n").collect()} == {("a", 1, 0), ("b", 2, 0)}
    assert round(23 / 369, 4) == 0.0623
    lines = spark.createDataFrame([(1, "hello world\nAB 123 CD\nthis is a very long line 1234567", 0.9)], "k int, t string, c double")
    assert ocr.choose_line(lines, "k", "t", "c").first()["candidate"] == "AB 123 CD"
    up = spark.createDataFrame([(100, 28), (100, 32)], "w int, h int").select(*ocr.upscale(F.col("w"), F.col("h"))).collect()
    assert tuple(up[0])[1:] == (343, 96) and tuple(up[1]) == (1.0, 100, 32)
