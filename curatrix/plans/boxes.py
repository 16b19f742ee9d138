"""Box geometry, validation and COCO queries over boxes derived from lineitem.

``lineitem`` stands for boxes and ``orders`` for images of 640 x 480. A box's numbers are
arithmetic of its row; some lie outside the image, as raw labels do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.functions import geometry as geo
from curatrix.operators.ranks import global_positions
from curatrix.plans.registry import Book
from curatrix.session import table
from curatrix.sinks.writers import coco_tables, sheet_layout, yolo_labels

BOOK = Book()
W, H = 640, 480

_BOXES = f"""SELECT l_orderkey AS image, l_partkey AS p, l_suppkey AS s, ((l_partkey * 7) % 700)::DOUBLE AS x0, ((l_suppkey * 13) % 500)::DOUBLE AS y0,
  l_quantity * 4 AS w, l_linenumber * 9.0::DOUBLE AS h, {W}.0::DOUBLE AS iw, {H}.0::DOUBLE AS ih FROM lineitem"""


def _boxes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("image"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"),
        ((F.col("l_partkey") * 7) % 700).cast("double").alias("x0"), ((F.col("l_suppkey") * 13) % 500).cast("double").alias("y0"),
        (F.col("l_quantity") * 4).alias("w"), (F.col("l_linenumber") * 9.0).alias("h"), F.lit(float(W)).alias("iw"), F.lit(float(H)).alias("ih"),
    )


def _r(columns, names, places: int = 8):
    return [F.round(c, places).alias(n) for c, n in zip(columns, names)]


@BOOK.query(f"""
SELECT image, p, s, round((x0 + w / 2) / iw, 8) AS cx, round((y0 + h / 2) / ih, 8) AS cy, round(w / iw, 8) AS cw, round(h / ih, 8) AS ch,
  round(((x0 + w / 2) / iw - w / iw / 2) * iw, 8) AS px, round(((y0 + h / 2) / ih - h / ih / 2) * ih, 8) AS py, round(w / iw * iw * (h / ih * ih), 4) AS area FROM ({_BOXES})
""")
def box_convert(spark: SparkSession, folder: str) -> DataFrame:
    b = _boxes(spark, folder)
    c = geo.xywh_to_centre(*(F.col(x) for x in ("x0", "y0", "w", "h", "iw", "ih")))
    px = geo.centre_to_pixels(*c, F.col("iw"), F.col("ih"))
    return b.select("image", "p", "s", *_r(c, ("cx", "cy", "cw", "ch")), *_r(px[:2], ("px", "py")), F.round(px[2] * px[3], 4).alias("area"))


@BOOK.query(f"""
SELECT array_to_string(list_sort(list_filter([CASE WHEN w <= 0 OR h <= 0 THEN 'not_positive' END, CASE WHEN x0 < 0 OR y0 < 0 OR x0 + w > iw OR y0 + h > ih THEN 'outside' END], lambda e: e IS NOT NULL)), ';') AS errors,
  CASE WHEN h = 9 THEN 'flat' ELSE 'tall' END AS shape, count(*) AS row_count FROM ({_BOXES}) GROUP BY 1, 2
""")
def box_validate(spark: SparkSession, folder: str) -> DataFrame:
    b = _boxes(spark, folder)
    errors = geo.box_errors(tuple(F.col(x) for x in ("x0", "y0", "w", "h")), "xywh", (F.col("iw"), F.col("ih")))
    rows = b.select(F.array_join(errors, ";").alias("errors"), F.when(F.col("h") == 9, "flat").otherwise("tall").alias("shape"))
    return rows.groupBy("errors", "shape").agg(F.count(F.lit(1)).alias("row_count"))


_UNIT = f"SELECT *, x0 / iw AS a, y0 / ih AS b, (x0 + w) / iw AS c, (y0 + h) / ih AS d FROM ({_BOXES})"
_OVER = f"SELECT *, greatest(0, -a, -b, c - 1, d - 1) AS o FROM ({_UNIT})"


@BOOK.query(f"""
SELECT CASE WHEN o <= 0 THEN 'valid' WHEN o <= 1e-4 THEN '<=1e-4' WHEN o <= 1e-3 THEN '<=1e-3' WHEN o <= 1e-2 THEN '<=1e-2' WHEN o <= 5e-2 THEN '<=5e-2' ELSE '>5e-2' END AS bucket,
  count(*) AS row_count, count(*) FILTER (least(greatest(c, 0), 1) - least(greatest(a, 0), 1) <= 0 OR least(greatest(d, 0), 1) - least(greatest(b, 0), 1) <= 0 OR o > 5e-2) AS cannot_clip FROM ({_OVER}) GROUP BY 1
""")
def overshoot_buckets(spark: SparkSession, folder: str) -> DataFrame:
    u = _unit(spark, folder)
    box = tuple(F.col(x) for x in "abcd")
    rows = u.select(geo.overshoot_bucket(geo.overshoot(*box)).alias("bucket"), geo.cannot_clip(*box).alias("bad"))
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("row_count"), F.count_if("bad").alias("cannot_clip"))


def _unit(spark: SparkSession, folder: str) -> DataFrame:
    b = _boxes(spark, folder)
    return b.withColumns({"a": F.col("x0") / F.col("iw"), "b": F.col("y0") / F.col("ih"), "c": (F.col("x0") + F.col("w")) / F.col("iw"), "d": (F.col("y0") + F.col("h")) / F.col("ih")})


@BOOK.query(f"""
SELECT image, count(*) AS boxes, count(*) FILTER (o > 0) AS outside, round(max(o), 9) AS worst, round(min(w * h), 6) AS least_area, round(max(w * h), 6) AS most_area FROM ({_OVER}) GROUP BY 1
""")
def image_box_rollup(spark: SparkSession, folder: str) -> DataFrame:
    o = geo.overshoot(*(F.col(x) for x in "abcd"))
    rows = _unit(spark, folder).select("image", o.alias("o"), (F.col("w") * F.col("h")).alias("area"))
    return rows.groupBy("image").agg(
        F.count(F.lit(1)).alias("boxes"), F.count_if(F.col("o") > 0).alias("outside"), F.round(F.max("o"), 9).alias("worst"), F.round(F.min("area"), 6).alias("least_area"), F.round(F.max("area"), 6).alias("most_area")
    )


@BOOK.query(f"""
WITH t AS (SELECT image, CASE WHEN w / h < 1.2 THEN 3 ELSE 0 END + CASE WHEN w * h / (iw * ih) > 0.25 THEN 3 ELSE 0 END + CASE WHEN w * h / (iw * ih) < 0.001 THEN 1 ELSE 0 END AS pts FROM ({_BOXES}))
SELECT image, (sum(pts) + CASE WHEN count(*) >= 3 THEN 2 ELSE 0 END)::BIGINT AS points FROM t GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 40
""")
def suspicion_topk(spark: SparkSession, folder: str) -> DataFrame:
    pts = geo.suspicion(*(F.col(x) for x in ("w", "h", "iw", "ih")))
    rows = _boxes(spark, folder).select("image", pts.alias("pts")).groupBy("image").agg(geo.suspicion_total(F.col("pts")).alias("points"))
    return rows.orderBy(F.desc("points"), "image").limit(40)


@BOOK.query(f"""
WITH q AS (SELECT *, (p % 4) * 90 AS deg, x0 + w AS x1, y0 + h AS y1 FROM ({_BOXES}))
SELECT image, p, s, deg, CASE deg WHEN 0 THEN x0 WHEN 90 THEN ih - y1 WHEN 180 THEN iw - x1 ELSE y0 END AS rx0, CASE deg WHEN 0 THEN y0 WHEN 90 THEN x0 WHEN 180 THEN ih - y1 ELSE iw - x1 END AS ry0, x0 AS bx0, y0 AS by0 FROM q
""")
def box_rotation(spark: SparkSession, folder: str) -> DataFrame:
    b = _boxes(spark, folder).withColumn("deg", (F.col("p") % 4) * 90)
    box = (F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h"))
    turned = geo.rotate_clockwise(box, F.col("iw"), F.col("ih"), F.col("deg"))
    back = geo.rotate_back(turned, F.col("iw"), F.col("ih"), F.col("deg"))
    return b.select("image", "p", "s", "deg", turned[0].alias("rx0"), turned[1].alias("ry0"), back[0].alias("bx0"), back[1].alias("by0"))


@BOOK.query("""
SELECT canonical_id, round(least(512.0::DOUBLE / height, 512.0::DOUBLE / width), 9) AS scale, floor(width * least(512.0::DOUBLE / height, 512.0::DOUBLE / width))::INTEGER AS new_width,
  floor(height * least(512.0::DOUBLE / height, 512.0::DOUBLE / width))::INTEGER AS new_height FROM fingerprints WHERE width > 0 AND height > 0
""")
def letterbox(spark: SparkSession, folder: str) -> DataFrame:
    f = table(spark, folder, "fingerprints").where("width > 0 and height > 0")
    w, h = geo.letterbox_size(F.col("width"), F.col("height"), 512.0)
    return f.select("canonical_id", F.round(geo.letterbox_scale(F.col("width"), F.col("height"), 512.0), 9).alias("scale"), w.alias("new_width"), h.alias("new_height"))


@BOOK.query(f"""
WITH c AS (SELECT *, x0 + w AS x1, y0 + h AS y1, round_even((x0 + w - x0) * 0.08::DOUBLE, 0) AS mx, round_even((y0 + h - y0) * 0.08::DOUBLE, 0) AS my FROM ({_BOXES}))
SELECT image, p, s, greatest(0, x0 - mx)::INTEGER AS left_edge, greatest(0, y0 - my)::INTEGER AS top_edge, least(iw, x1 + mx)::INTEGER AS right_edge, least(ih, y1 + my)::INTEGER AS bottom_edge FROM c
""")
def padded_crops(spark: SparkSession, folder: str) -> DataFrame:
    b = _boxes(spark, folder)
    edges = geo.padded_crop(F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h"), F.col("iw"), F.col("ih"))
    return b.select("image", "p", "s", *(e.alias(n) for e, n in zip(edges, ("left_edge", "top_edge", "right_edge", "bottom_edge"))))


@BOOK.query(f"""
WITH g AS (SELECT image, list_sort(list([round_even(x0 / 3, 3), round_even(y0 / 3, 3)])) AS sig FROM ({_BOXES}) GROUP BY 1)
SELECT array_to_string(list_transform(sig, lambda r: r[1] || ';' || r[2]), '|') AS signature, count(*) AS images FROM g GROUP BY 1
""")
def box_signatures(spark: SparkSession, folder: str) -> DataFrame:
    """Images of equal boxes: the whole signature of each image, all of its boxes."""
    b = _boxes(spark, folder).select("image", (F.col("x0") / 3).alias("a"), (F.col("y0") / 3).alias("b"))
    sig = b.groupBy("image").agg(geo.box_signature(["a", "b"], 3).alias("sig"))
    text = F.array_join(F.transform("sig", lambda r: F.concat_ws(";", r["a"].cast("string"), r["b"].cast("string"))), "|")
    return sig.select(text.alias("signature")).groupBy("signature").agg(F.count(F.lit(1)).alias("images"))


_INDEXED = f"""SELECT *, row_number() OVER (PARTITION BY image ORDER BY p, s, w, h) AS box_index FROM ({_BOXES} JOIN orders ON o_orderkey = l_orderkey)"""


def _samples(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    from curatrix.operators.review import index_in_group

    images = table(spark, folder, "orders").select(F.col("o_orderkey").alias("canonical_id"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".jpg")).alias("file_name"), F.lit(W).alias("width"), F.lit(H).alias("height"))
    b = index_in_group(_boxes(spark, folder), "image", ["p", "s", "w", "h"])
    c = geo.xywh_to_centre(*(F.col(x) for x in ("x0", "y0", "w", "h", "iw", "ih")))
    boxes = b.select(F.col("image").alias("canonical_id"), F.col("variant_index").alias("box_index"), *(v.alias(n) for v, n in zip(c, ("x_center", "y_center", "width", "height"))), F.lit(0).alias("class_id"))
    return images, boxes.join(images.select("canonical_id"), "canonical_id", "left_semi")


@BOOK.query(f"SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey || '.jpg' AS file_name, {W} AS width, {H} AS height FROM orders")
def coco_images(spark: SparkSession, folder: str) -> DataFrame:
    return coco_tables(*_samples(spark, folder))[0]


@BOOK.query(f"""
WITH o AS (SELECT o_orderkey AS image, row_number() OVER (ORDER BY o_orderkey) AS image_id FROM orders), b AS (SELECT * FROM ({_INDEXED}) JOIN o USING (image))
SELECT row_number() OVER (ORDER BY image_id, box_index) AS id, image_id, round(((x0 + w / 2) / iw - w / iw / 2) * iw, 4) AS bx, round(w / iw * iw * (h / ih * ih), 4) AS area FROM b
""")
def coco_annotations(spark: SparkSession, folder: str) -> DataFrame:
    rows = coco_tables(*_samples(spark, folder))[1]
    return rows.select("id", "image_id", F.round(F.col("bbox")[0], 4).alias("bx"), F.round("area", 4).alias("area"))


@BOOK.query(f"""
WITH t AS (SELECT image, box_index, printf('%d %.8f %.8f %.8f %.8f', 0, (x0 + w / 2) / iw, (y0 + h / 2) / ih, w / iw, h / ih) AS line FROM ({_INDEXED}))
SELECT o_orderkey AS canonical_id, coalesce(string_agg(line, chr(10) ORDER BY box_index) || chr(10), '') AS text FROM orders LEFT JOIN t ON t.image = o_orderkey GROUP BY 1
""")
def yolo_label_files(spark: SparkSession, folder: str) -> DataFrame:
    return yolo_labels(*_samples(spark, folder), "canonical_id")


@BOOK.query("""
WITH r AS (SELECT p_partkey, row_number() OVER (ORDER BY p_name, p_partkey) - 1 AS k FROM part)
SELECT p_partkey, k // 20 AS sheet, (k % 20) // 5 AS "row", (k % 20) % 5 AS "column" FROM r
""")
def contact_sheets(spark: SparkSession, folder: str) -> DataFrame:
    return sheet_layout(table(spark, folder, "part").select("p_partkey", "p_name"), ["p_name", "p_partkey"], 5, 20).select("p_partkey", "sheet", "row", "column")


@BOOK.query("SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS position FROM documents WHERE n_chars IS NOT NULL")
def dense_positions(spark: SparkSession, folder: str) -> DataFrame:
    return global_positions(table(spark, folder, "documents").where("n_chars is not null").select("doc_id", "n_chars"), ["n_chars", "doc_id"]).select("doc_id", "position")
