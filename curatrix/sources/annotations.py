"""Annotation formats: Pascal VOC XML, COCO JSON, YOLO text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.contracts import ContractError
from curatrix.functions.geometry import box_errors
from curatrix.functions.text import stem
from curatrix.sources.files import list_files

VOC_SCHEMA = """filename STRING, size STRUCT<width: INT, height: INT>,
object ARRAY<STRUCT<name: STRING, bndbox: STRUCT<xmin: DOUBLE, ymin: DOUBLE, xmax: DOUBLE, ymax: DOUBLE>>>"""
COCO_SCHEMA = """info STRUCT<description: STRING, version: STRING>, licenses ARRAY<STRING>,
images ARRAY<STRUCT<id: BIGINT, file_name: STRING, width: INT, height: INT>>,
annotations ARRAY<STRUCT<id: BIGINT, image_id: BIGINT, category_id: INT, bbox: ARRAY<DOUBLE>, area: DOUBLE, iscrowd: INT, segmentation: ARRAY<ARRAY<DOUBLE>>>>,
categories ARRAY<STRUCT<id: INT, name: STRING, supercategory: STRING>>"""
YOLO_FIELDS = ("class_id", "x_center", "y_center", "width", "height")


def read_voc(spark: SparkSession, path: str, mode: str = "collect") -> DataFrame:
    """One row a box: ``path, stem, filename, width, height, box_index, name, xmin, ymin, xmax, ymax, errors``.

    ``box_index`` is 1-based; an image without objects has one row with null box
    columns. ``errors`` lists broken rules (missing size or corner, inverted, outside
    the image). ``mode`` "collect" keeps such boxes, "skip" drops them, "raise" fails.
    A file that isn't XML, or has no bytes, has one row with ``errors`` = [unreadable].
    """
    raw = list_files(spark, path, [".xml"], recursive=True, content=True)
    text = F.decode("content", "UTF-8")
    rows = raw.select("path", stem(F.col("path")).alias("stem"), F.from_xml(text, VOC_SCHEMA, {"mode": "PERMISSIVE"}).alias("a"))
    rows = rows.select("path", "stem", "a.filename", "a.size.width", "a.size.height", F.col("a").isNull().alias("_bad"), F.posexplode_outer("a.object").alias("_i", "o"))
    box = tuple(F.col(f"o.bndbox.{c}") for c in ("xmin", "ymin", "xmax", "ymax"))
    sized = (F.col("width") > 0) & (F.col("height") > 0)
    rules = F.when(F.coalesce(sized, F.lit(False)), box_errors(box, "xyxy", (F.col("width"), F.col("height")))).otherwise(F.array(F.lit("no_size")))
    empty = F.array().cast("array<string>")
    errors = F.when(F.col("_bad") | (F.col("filename").isNull() & F.col("width").isNull() & F.col("o").isNull()), F.array(F.lit("unreadable"))).when(F.col("o").isNull(), empty).otherwise(rules)
    out = rows.select("path", "stem", "filename", "width", "height", (F.col("_i") + 1).alias("box_index"), F.col("o.name").alias("name"), *(b.alias(n) for b, n in zip(box, ("xmin", "ymin", "xmax", "ymax"))), errors.alias("errors"))
    return _by_mode(out, mode)


def _by_mode(rows: DataFrame, mode: str) -> DataFrame:
    if mode == "collect":
        return rows
    good = F.size("errors") == 0
    if mode == "skip":
        return rows.where(good)
    if mode == "raise":
        if bad := rows.where(~good).select("path", "errors").limit(5).collect():
            raise ContractError(f"bad annotations: {[tuple(b) for b in bad]}")
        return rows
    raise ValueError(mode)


def read_coco(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables ``images``, ``annotations`` (``bbox`` as x, y, w, h) and ``categories`` of COCO documents, each with ``path``."""
    docs = spark.read.schema(COCO_SCHEMA).option("multiLine", "true").json(path).select("*", F.col("_metadata.file_path").alias("path"))
    images = docs.select("path", F.inline("images"))
    categories = docs.select("path", F.inline("categories"))
    box = [F.col("bbox")[i].alias(n) for i, n in enumerate("xywh")]
    annotations = docs.select("path", F.inline("annotations")).select("path", "id", "image_id", "category_id", *box, "area", "iscrowd", "segmentation")
    return {"images": images, "annotations": annotations, "categories": categories}


def coco_boxes(tables: dict[str, DataFrame]) -> DataFrame:
    """Annotations with their image and category; an unknown category is ``UNKNOWN_<id>``, an unknown image gives a null file name."""
    images = tables["images"].select("path", F.col("id").alias("image_id"), "file_name", F.col("width").alias("image_width"), F.col("height").alias("image_height"))
    names = tables["categories"].select("path", F.col("id").alias("category_id"), "name")
    rows = tables["annotations"].join(images, ["path", "image_id"], "left").join(names, ["path", "category_id"], "left")
    errors = box_errors(tuple(F.col(c) for c in "xywh"), "xywh", (F.col("image_width"), F.col("image_height")))
    return rows.withColumns({"name": F.coalesce("name", F.concat(F.lit("UNKNOWN_"), F.col("category_id"))), "errors": F.when(F.col("file_name").isNull(), F.array(F.lit("unknown_image"))).otherwise(errors)})


def read_yolo(spark: SparkSession, path: str, mode: str = "collect", slack: float = 1e-6, corner_slack: float | None = None) -> DataFrame:
    """One row a line: ``path, stem, line_number, class_id, x_center, y_center, width, height, errors``.

    Blank lines are ignored; an empty file (a negative image) has one row with a null
    line number. ``errors``: ``tokens`` (not five), ``not_a_number``, and the rules of a
    normalised box. Modes as for ``read_voc``.
    """
    files = list_files(spark, path, [".txt"], recursive=True, content=True).select("path", F.decode("content", "UTF-8").alias("value"))
    lines = files.select("path", F.posexplode_outer(F.filter(F.transform(F.split("value", r"\r?\n"), lambda v, i: F.struct((i + 1).alias("n"), F.trim(v).alias("v"))), lambda x: x["v"] != "")).alias("_i", "l"))
    parts = F.split(F.col("l.v"), r"\s+")
    rows = lines.select("path", stem(F.col("path")).alias("stem"), F.col("l.n").alias("line_number"), parts.alias("p"))
    number = lambda i: F.expr(f"try_cast(get(p, {i}) as double)")
    rows = rows.withColumns({n: number(i) for i, n in enumerate(YOLO_FIELDS)})
    box = tuple(F.col(c) for c in YOLO_FIELDS[1:])
    nulls = F.greatest(*(F.col(c).isNull() for c in YOLO_FIELDS)) | (F.col("class_id") != F.floor("class_id"))
    errors = (
        F.when(F.col("line_number").isNull(), F.array().cast("array<string>"))
        .when(F.size("p") != 5, F.array(F.lit("tokens")))
        .when(nulls, F.array(F.lit("not_a_number")))
        .otherwise(box_errors(box, "cxcywh", slack=slack, corner_slack=corner_slack))
    )
    return _by_mode(rows.withColumn("errors", errors).withColumn("class_id", F.expr("try_cast(class_id as int)")).drop("p"), mode)


def coco_differences(tables: dict[str, DataFrame], images: DataFrame, annotations: DataFrame, relative: float = 1e-9, absolute: float = 1e-6) -> DataFrame:
    """A COCO document read back against the tables it was written from: ``file_name, problem``, empty if they agree.

    Problems: ``missing`` or ``unexpected`` image, ``id``, ``size``, ``box_count``,
    ``box`` (a corner, size or area beyond the tolerance, boxes of an image compared in
    sorted order) and ``category``. The boxes of one image are bounded.
    """
    from pyspark.sql import Window

    from curatrix.functions.geometry import close_to

    want = images.select("file_name", *(F.col(c).alias(f"w_{c}") for c in ("id", "width", "height"))).withColumn("w", F.lit(True))
    have = tables["images"].select("file_name", *(F.col(c).alias(f"h_{c}") for c in ("id", "width", "height"))).withColumn("h", F.lit(True))
    both = want.join(have, "file_name", "full_outer")
    size = (F.col("w_width") != F.col("h_width")) | (F.col("w_height") != F.col("h_height"))
    problem = F.when(F.col("h").isNull(), "missing").when(F.col("w").isNull(), "unexpected").when(F.col("w_id") != F.col("h_id"), "id").when(size, "size")
    out = both.select("file_name", problem.alias("problem")).where("problem is not null")

    def placed(rows: DataFrame, names: DataFrame, box: list, prefix: str) -> DataFrame:
        named = rows.join(names.select(F.col("id").alias("image_id"), "file_name"), "image_id")
        flat = named.select("file_name", *(b.alias(f"{prefix}{k}") for k, b in enumerate(box)), F.col("area").alias(f"{prefix}4"), F.col("category_id").alias(f"{prefix}5"))
        order = Window.partitionBy("file_name").orderBy(*(F.bround(f"{prefix}{k}", 4) for k in range(4)))
        return flat.withColumn("at", F.row_number().over(order))

    a = placed(annotations, images, [F.col("bbox")[k] for k in range(4)], "a")
    b = placed(tables["annotations"], tables["images"], [F.col(c) for c in "xywh"], "b")
    near = close_to(F.col("a0"), F.col("b0"), relative, absolute)
    for k in range(1, 5):
        near = near & close_to(F.col(f"a{k}"), F.col(f"b{k}"), relative, absolute)
    problem = F.when(F.col("a0").isNull() | F.col("b0").isNull(), "box_count").when(~near, "box").when(F.col("a5") != F.col("b5"), "category")
    boxes = a.join(b, ["file_name", "at"], "full_outer").select("file_name", problem.alias("problem")).where("problem is not null")
    return out.unionByName(boxes).distinct()
