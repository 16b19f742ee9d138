import hashlib

import pytest
from pyspark.sql import functions as F

from curatrix.functions import geometry as geo
from curatrix.functions import hashing as hs
from curatrix.functions import text as tx


def one(spark, *cols, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return row.select(*cols).first()


def texts(spark, fn, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_source_names(spark):
    rf = "a_jpg.rf." + "0" * 32 + ".jpg"
    assert texts(spark, tx.strip_export_suffix, rf, "a.jpg", None, "") == ["a_jpg", "a.jpg", None, ""]
    assert texts(spark, tx.sequence_name, "x.mp4#t=558.jpg", "y.jpg", None) == ["x.mp4", "y", None]
    assert texts(spark, lambda c: tx.sequence_frame(c, strict=False), "x.mp4#t=558.jpg", "y.jpg") == [("x.mp4", 558), None]
    with pytest.raises(Exception, match="not a frame"):
        texts(spark, tx.sequence_frame, "y.jpg")
    assert texts(spark, tx.stem, "/a/b.c.JPG", "b", "a\\x.png", None) == ["b.c", "b", "x", None]
    assert texts(spark, tx.suffix, "/a/b.c.JPG", "b") == [".jpg", ""]
    assert texts(spark, lambda c: tx.inside(c, F.lit("/r")), "/r/a", "/r/../x", "/rx/a", "/r//./a") == [True, False, False, True]


def test_flags_and_lists(spark):
    assert texts(spark, tx.is_hex_id, "0123456789abcdef", "0123456789ABCDEF0", None) == [True, False, False]
    assert texts(spark, lambda c: tx.to_bool(c, False), " TRUE ", "no", "2", None) == [True, False, None, None]
    with pytest.raises(Exception, match="not a boolean"):
        texts(spark, tx.to_bool, "maybe")
    assert texts(spark, tx.is_plate_class, "License-Plate", " number plate", "car", None) == [True, True, False, False]
    assert texts(spark, tx.list_items, "a; b;;c ", "", None) == [["a", "b", "c"], [], None]
    assert texts(spark, tx.fill_blank, " ", None, "x") == ["<MISSING>", "<MISSING>", "x"]
    assert texts(spark, lambda c: tx.move_prefix(c, "a/", "b/"), "a/x", "xa/", None) == ["b/x", "xa/", None]
    assert texts(spark, tx.ocr_plain, "CB-K 4280", "-FBoF 8715") == ["CBK4280", "FBOF8715"]
    df = spark.createDataFrame([(1, 2)], "` ImageID ` int, other int")
    assert tx.alias_headers(df, {"ImageID": []}).columns == ["ImageID", "other"]


def test_hashes(spark):
    assert texts(spark, hs.hex64, "ffffffffffffffff", "7FFFFFFFFFFFFFFF", "xyz", None) == [-1, 2**63 - 1, None, None]
    assert one(spark, hs.hamming(F.lit(-1).cast("bigint"), F.lit(2**63 - 1)))[0] == 1
    assert one(spark, hs.stable_id(F.lit("p"), F.lit("x")))[0] == "p__" + hashlib.sha256(b"x").hexdigest()[:16]
    values = F.array(*(F.lit(float(i)) for i in range(64)))
    assert one(spark, hs.median_without_first(values))[0] == 32.0
    assert one(spark, hs.pack_bits(values, F.lit(31.0)))[0] == 2**32 - 1


def test_boxes(spark):
    box = [F.lit(x) for x in (100.0, 50.0, 300.0, 200.0)]
    w, h = F.lit(1280.0), F.lit(720.0)
    for degrees in (0, 90, 180, 270):
        turned = geo.rotate_clockwise(box, w, h, F.lit(degrees))
        assert one(spark, *geo.rotate_back(turned, w, h, F.lit(degrees))) == (100.0, 50.0, 300.0, 200.0)
        bounds = (720, 1280) if degrees in (90, 270) else (1280, 720)
        x0, y0, x1, y1 = one(spark, *turned)
        assert 0 <= x0 < x1 <= bounds[0] and 0 <= y0 < y1 <= bounds[1]
    with pytest.raises(Exception, match="quarter turn"):
        one(spark, *geo.rotate_clockwise(box, w, h, F.lit(45)))
    assert one(spark, geo.letterbox_scale(w, h, 512))[0] == 0.4
    assert one(spark, *geo.letterbox_size(w, h, 512)) == (512, 288)
    centre = geo.xyxy_to_centre(*box, w, h)
    back = geo.centre_to_pixels(*centre, w, h)
    assert [round(x, 6) for x in one(spark, *back)] == [100.0, 50.0, 200.0, 150.0]
    assert one(spark, geo.iou(box, [F.lit(x) for x in (100.0, 50.0, 200.0, 200.0)]))[0] == pytest.approx(0.5)


@pytest.mark.parametrize("amount,name", [(0.0, "valid"), (1e-4, "<=1e-4"), (1e-3, "<=1e-3"), (1e-2, "<=1e-2"), (5e-2, "<=5e-2"), (0.06, ">5e-2"), (None, None)])
def test_bucket_edges(spark, amount, name):
    assert one(spark, geo.overshoot_bucket(F.lit(amount).cast("double")))[0] == name


def test_box_errors(spark):
    size = (F.lit(10), F.lit(10))
    lit = lambda *v: tuple(F.lit(x).cast("double") for x in v)
    assert one(spark, geo.box_errors(lit(0, 0, 5, 5), "xyxy", size))[0] == []
    assert one(spark, geo.box_errors(lit(5, 0, 4, 11), "xyxy", size))[0] == ["inverted", "outside"]
    assert one(spark, geo.box_errors(lit(8, 0, 4, 0), "xywh", size))[0] == ["not_positive", "outside"]
    assert one(spark, geo.box_errors(lit(0.5, 1.5, 0.1, 0), "cxcywh"))[0] == ["centre", "size"]
    assert one(spark, geo.box_errors(lit(0.01, 0.5, 0.1, 0.1), "cxcywh", corner_slack=1e-7))[0] == ["corner"]
    assert one(spark, geo.box_errors(lit(float("nan"), 0, 1, 1), "cxcywh"))[0] == ["not_finite"]
    assert one(spark, geo.box_errors(lit(None, 0, 1, 1), "cxcywh"))[0] == ["not_finite"]


def test_crop_and_close(spark):
    crop = geo.padded_crop(*(F.lit(x) for x in (10.0, 10.0, 35.0, 35.0)), F.lit(36.0), F.lit(100.0))
    assert one(spark, *crop) == (8, 8, 36, 37)
    assert one(spark, geo.close_to(F.lit(1.0), F.lit(1.0 + 5e-7)), geo.close_to(F.lit(1.0), F.lit(1.1))) == (True, False)
    assert one(spark, geo.aspect_difference(F.lit(1.0), F.lit(0.85)))[0] == pytest.approx(0.15)
    none = F.lit(None).cast("double")
    assert one(spark, geo.clip01(none), geo.overshoot(none, *(F.lit(0.0),) * 3), geo.iou((none,) * 4, (F.lit(0.0),) * 4), geo.letterbox_scale(none, F.lit(2.0), 5)) == (None,) * 4
    assert one(spark, geo.suspicion(F.lit(10.0), F.lit(10.0), F.lit(1000.0), F.lit(1000.0)))[0] == 4
