"""Box geometry as column expressions.

A box is four columns. ``xyxy`` are corners, ``xywh`` the top-left corner and the size,
``cxcywh`` the centre and the size; all but the pixel forms are in units of the image.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]
BUCKET_EDGES = (0.0, 1e-4, 1e-3, 1e-2, 5e-2)


def _if_all(value: Column, *needed: Column) -> Column:
    """``value`` where nothing is null; least() and greatest() alone would pass over nulls."""
    known = needed[0].isNotNull()
    for c in needed[1:]:
        known = known & c.isNotNull()
    return F.when(known, value)


def xyxy_to_centre(x0: Column, y0: Column, x1: Column, y1: Column, width: Column | float = 1.0, height: Column | float = 1.0) -> Box:
    """Corners in pixels (or in units, with the default size 1) to the normalised centre form."""
    w, h = (F.lit(v) if not isinstance(v, Column) else v for v in (width, height))
    return (x0 + x1) / 2 / w, (y0 + y1) / 2 / h, (x1 - x0) / w, (y1 - y0) / h


def xywh_to_centre(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Box:
    return (x + w / 2) / width, (y + h / 2) / height, w / width, h / height


def centre_to_xyxy(cx: Column, cy: Column, w: Column, h: Column) -> Box:
    return cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2


def centre_to_pixels(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> Box:
    """Normalised centre form to ``x, y, w, h`` in pixels; the area is ``w * h``."""
    return (cx - w / 2) * width, (cy - h / 2) * height, w * width, h * height


def clip01(x: Column) -> Column:
    return _if_all(F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)), x)


def overshoot(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """How far the box reaches beyond the unit square, 0 if it doesn't."""
    return _if_all(F.greatest(F.lit(0.0), -x0, -y0, x1 - 1, y1 - 1), x0, y0, x1, y1)


def overshoot_bucket(amount: Column) -> Column:
    """``valid`` for 0, then upper-inclusive buckets, then ``>5e-2``; null for null."""
    out = F.lit(">5e-2")
    for edge, name in reversed(list(zip(BUCKET_EDGES, ("valid", "<=1e-4", "<=1e-3", "<=1e-2", "<=5e-2")))):
        out = F.when(amount <= edge, F.lit(name)).otherwise(out)
    return F.when(amount.isNotNull(), out)


def cannot_clip(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A box that has no size left after clipping, or reaches too far out to be a rounding slip."""
    flat = (clip01(x1) - clip01(x0) <= 0) | (clip01(y1) - clip01(y0) <= 0)
    return flat | (overshoot(x0, y0, x1, y1) > BUCKET_EDGES[-1])


def is_finite(x: Column) -> Column:
    """False for null, NaN and the infinities."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def box_errors(box: Box, form: str, size: tuple[Column, Column] | None = None, slack: float = 0.0, corner_slack: float | None = None) -> Column:
    """Sorted array of the rules a box breaks, empty for a valid box.

    ``not_finite`` first and alone. ``form`` "xyxy": ``inverted`` and ``outside`` the
    pixel ``size``. "xywh": ``not_positive`` and ``outside``. "cxcywh": ``centre`` not
    in 0..1, ``size`` not in (0, 1], each within ``slack``; with ``corner_slack`` also
    ``corner`` beyond 0..1 by more than that.
    """
    a, b, c, d = box
    finite = is_finite(a) & is_finite(b) & is_finite(c) & is_finite(d)
    if form == "xyxy":
        w, h = size
        rules = [("inverted", (c <= a) | (d <= b)), ("outside", (a < -slack) | (b < -slack) | (c > w + slack) | (d > h + slack))]
    elif form == "xywh":
        w, h = size
        rules = [("not_positive", (c <= 0) | (d <= 0)), ("outside", (a < -slack) | (b < -slack) | (a + c > w + slack) | (b + d > h + slack))]
    elif form == "cxcywh":
        out = lambda x: (x < -slack) | (x > 1 + slack)
        rules = [("centre", out(a) | out(b)), ("size", (c <= 0) | (d <= 0) | (c > 1 + slack) | (d > 1 + slack))]
        if corner_slack is not None:
            edges = centre_to_xyxy(a, b, c, d)
            beyond = F.greatest(*(F.greatest(-e, e - 1) for e in edges)) > corner_slack
            rules.append(("corner", beyond))
    else:
        raise ValueError(form)
    broken = F.array_compact(F.array_sort(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules))))
    return F.when(finite, broken).otherwise(F.array(F.lit("not_finite")))


def aspect(w: Column, h: Column) -> Column:
    return F.try_divide(w, h)


def area_share(w: Column, h: Column, width: Column, height: Column) -> Column:
    return F.try_divide(w * h, width * height)


def suspicion(w: Column, h: Column, width: Column, height: Column) -> Column:
    """Points of one box: 3 if narrower than 1.2 times its height, 3 if over a quarter of the image, 1 if under a thousandth."""
    share = area_share(w, h, width, height)
    points = lambda when, n: F.when(when, n).otherwise(0)
    return points(aspect(w, h) < 1.2, 3) + points(share > 0.25, 3) + points(share < 0.001, 1)


def suspicion_total(points: Column) -> Column:
    """Aggregate: points of an image's boxes, and 2 more for three boxes or more."""
    return F.coalesce(F.sum(points), F.lit(0)) + F.when(F.count(points) >= 3, 2).otherwise(0)


def iou(a: Box, b: Box) -> Column:
    """Intersection over union of two boxes of corners; the union counts as 1e-9 at least; null if any corner is."""
    side = lambda lo1, hi1, lo2, hi2: F.greatest(F.least(hi1, hi2) - F.greatest(lo1, lo2), F.lit(0.0))
    both = side(a[0], a[2], b[0], b[2]) * side(a[1], a[3], b[1], b[3])
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    return _if_all(both / F.greatest(area(a) + area(b) - both, F.lit(1e-9)), *a, *b)


def padded_crop(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column, share: float = 0.08) -> Box:
    """Whole-pixel crop with ``share`` of each side as margin (rounded half to even), kept inside the image."""
    px, py = (F.bround((hi - lo) * F.lit(share)) for lo, hi in ((x0, x1), (y0, y1)))
    zero = F.lit(0)
    return tuple(
        _if_all(v, x0, y0, x1, y1, width, height).cast("int")
        for v in (F.greatest(zero, x0 - px), F.greatest(zero, y0 - py), F.least(width, x1 + px), F.least(height, y1 + py))
    )


def rotate_clockwise(box: Box, width: Column, height: Column, degrees: Column) -> Box:
    """Corners after the image of the given size is turned by 0, 90, 180 or 270 degrees; any other angle raises."""
    x0, y0, x1, y1 = box
    turns = {0: (x0, y0, x1, y1), 90: (height - y1, x0, height - y0, x1), 180: (width - x1, height - y1, width - x0, height - y0), 270: (y0, width - x1, y1, width - x0)}
    out = []
    for k in range(4):
        value = F.raise_error(F.concat(F.lit("no quarter turn: "), degrees.cast("string"))).cast("double")
        for angle, new in turns.items():
            value = F.when(degrees == angle, new[k]).otherwise(value)
        out.append(value)
    return tuple(out)


def rotate_back(box: Box, width: Column, height: Column, degrees: Column) -> Box:
    """Inverse of ``rotate_clockwise``; ``width`` and ``height`` are those before the turn."""
    turned = degrees.isin(90, 270)
    w, h = F.when(turned, height).otherwise(width), F.when(turned, width).otherwise(height)
    return rotate_clockwise(box, w, h, (F.lit(360) - degrees) % 360)


def letterbox_scale(width: Column, height: Column, side: float) -> Column:
    """Scale that fits the image into a square, placed at its top left."""
    return _if_all(F.least(F.lit(side) / height, F.lit(side) / width), width, height)


def letterbox_size(width: Column, height: Column, side: float) -> tuple[Column, Column]:
    """Whole pixels of the scaled image, cut off."""
    scale = letterbox_scale(width, height, side)
    return F.floor(width * scale).cast("int"), F.floor(height * scale).cast("int")


def close_to(a: Column, b: Column, relative: float = 1e-9, absolute: float = 1e-6) -> Column:
    return _if_all(F.abs(a - b) <= F.greatest(F.lit(relative) * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute)), a, b)


def aspect_difference(a: Column, b: Column) -> Column:
    """|a - b| as a share of the larger; null if either is null, or the larger is 0."""
    return F.try_divide(F.abs(a - b), F.greatest(a, b))


def box_signature(columns: list[str], places: int, by: str | None = None) -> Column:
    """Aggregate: the rounded boxes of an image as a sorted array, or in the order of ``by``."""
    numbers = [F.bround(F.col(c), places).alias(c) for c in columns]
    if by is None:
        return F.array_sort(F.collect_list(F.struct(*numbers)))
    rows = F.array_sort(F.collect_list(F.struct(F.col(by).alias("_at"), F.struct(*numbers).alias("_box"))))
    return F.transform(rows, lambda r: r["_box"])
