"""Sources and sinks: files are written from the test tables, read back, and compared with the tables.

``supplier`` stands for the images of a small dataset, one file or more for each row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.contracts import ContractError, physical_problems
from curatrix.functions.hashing import table_digest
from curatrix.operators.review import replica_check
from curatrix.plans.registry import Book
from curatrix.session import forget_folder, materialize, shared_folder, table
from curatrix.sinks import writers
from curatrix.sources import annotations, files, tables
from curatrix.sources.storage import put_files, store

BOOK = Book()


def _place(spark: SparkSession, tag: str) -> str:
    """A new folder in the shared one; it is removed when the driver's Python ends."""
    return forget_folder(f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}")


def _images(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(F.col("s_suppkey").alias("k"))


def _numbered(rows: DataFrame, n) -> DataFrame:
    """A row for each i of 1 .. n (none for 0)."""
    return rows.withColumn("i", F.explode(F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))))


_KEYS = "s AS (SELECT s_suppkey AS k FROM supplier)"
_BOXES = "b AS (SELECT k, i, k % 50 + i AS xmin, k % 45 AS ymin, k % 50 + i + CASE WHEN k % 10 = 0 THEN -5 ELSE 20 END AS xmax, k % 45 + 10 AS ymax FROM s, range(1, 3) t(i) WHERE i <= k % 3)"


def _voc_texts(rows: DataFrame) -> DataFrame:
    k = F.col("k")
    corner = lambda name, value: F.concat(F.lit(f"<{name}>"), value.cast("string"), F.lit(f"</{name}>"))
    box = lambda i: F.concat(
        F.lit("<object><name>plate</name><bndbox>"), corner("xmin", k % 50 + i), corner("ymin", k % 45), corner("xmax", k % 50 + i + F.when(k % 10 == 0, -5).otherwise(20)), corner("ymax", k % 45 + 10), F.lit("</bndbox></object>")
    )
    size = F.when(k % 7 == 0, F.lit("")).otherwise(F.lit("<size><width>100</width><height>50</height></size>"))
    objects = F.concat(F.when(k % 3 >= 1, box(F.lit(1))).otherwise(""), F.when(k % 3 >= 2, box(F.lit(2))).otherwise(""))
    whole = F.concat(F.lit("<annotation><filename>"), k.cast("string"), F.lit(".jpg</filename>"), size, objects, F.lit("</annotation>"))
    return rows.select(k.alias("name"), F.when(k % 11 == 0, "no annotation at all").when(k % 13 == 0, "").otherwise(whole).alias("text"))


@BOOK.query(f"""
WITH {_KEYS}, {_BOXES}, g AS (SELECT * FROM s WHERE k % 11 <> 0 AND k % 13 <> 0)
SELECT k AS image, NULL::BIGINT AS box_index, NULL AS name, NULL::DOUBLE AS xmin, NULL::DOUBLE AS ymax, 'unreadable' AS errors FROM s WHERE k % 11 = 0 OR k % 13 = 0
UNION ALL SELECT k, NULL, NULL, NULL, NULL, '' FROM g WHERE k % 3 = 0
UNION ALL SELECT k, i, 'plate', xmin, ymax, CASE WHEN k % 7 = 0 THEN 'no_size' ELSE concat_ws(';', CASE WHEN xmax <= xmin OR ymax <= ymin THEN 'inverted' END, CASE WHEN xmax > 100 OR ymax > 50 THEN 'outside' END) END FROM b JOIN g USING (k)
""")
def voc_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Annotations in XML, some broken, some of no bytes, some without a size or with bad boxes."""
    place = _place(spark, "voc")
    writers.write_texts(_voc_texts(_images(spark, folder)), place, ".xml")
    rows = annotations.read_voc(spark, place)
    return rows.select(F.col("stem").cast("long").alias("image"), F.col("box_index").cast("long").alias("box_index"), "name", "xmin", "ymax", F.array_join("errors", ";").alias("errors"))


def _yolo(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    images = _images(spark, folder)
    boxes = _numbered(images, F.col("k") % 3).select(
        "k", F.col("i").alias("box_index"), F.lit(0).alias("class_id"), (F.col("k") % 24 / 20).alias("x_center"), F.lit(0.5).alias("y_center"), F.lit(0.1).alias("width"), (F.col("i") / 10).alias("height")
    )
    return images, boxes


@BOOK.query(f"""
WITH {_KEYS}, b AS (SELECT k, i, round(k % 24 / 20, 8) AS x, i / 10 AS h FROM s, range(1, 3) t(i) WHERE i <= k % 3)
SELECT k AS image, i AS line_number, 0 AS class_id, x AS x_center, h AS height, CASE WHEN x > 1.000001 THEN 'centre' ELSE '' END AS errors FROM b
UNION ALL SELECT k, NULL, NULL, NULL, NULL, '' FROM s WHERE k % 3 = 0
""")
def yolo_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Label files, empty ones of negative images included."""
    place = _place(spark, "yolo")
    writers.write_yolo(writers.yolo_labels(*_yolo(spark, folder), "k"), "k", place)
    rows = annotations.read_yolo(spark, place)
    return rows.select(F.col("stem").cast("long").alias("image"), F.col("line_number").cast("long").alias("line_number"), "class_id", "x_center", "height", F.array_join("errors", ";").alias("errors"))


@BOOK.query(f"WITH {_KEYS} SELECT k AS image, CASE WHEN k % 3 = 0 THEN 'empty' ELSE 'filled' END AS state FROM s WHERE k % 2 = 0")
def stale_labels_removed(spark: SparkSession, folder: str) -> DataFrame:
    """A second run with half of the images leaves no label of the first behind."""
    place, labels = _place(spark, "yolo"), writers.yolo_labels(*_yolo(spark, folder), "k")
    writers.write_yolo(labels, "k", place)
    writers.write_yolo(labels.where("k % 2 = 0"), "k", place)
    return files.list_files(spark, place, [".txt"]).select(F.col("stem").cast("long").alias("image"), F.when(F.col("length") == 0, "empty").otherwise("filled").alias("state"))


def _coco(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    images, boxes = _yolo(spark, folder)
    samples = images.select(F.lpad(F.col("k").cast("string"), 8, "0").alias("canonical_id"), F.concat("k", F.lit(".jpg")).alias("file_name"), F.lit(200).alias("width"), F.lit(100).alias("height"))
    return writers.coco_tables(samples, boxes.withColumn("canonical_id", F.lpad(F.col("k").cast("string"), 8, "0")).drop("k"))


_COCO = f"""{_KEYS}, m AS (SELECT k, row_number() OVER (ORDER BY k) AS image_id FROM s),
b AS (SELECT k, image_id, i, row_number() OVER (ORDER BY image_id, i) AS id, (k % 24 / 20 - 0.05::DOUBLE) * 200 AS x, (0.5::DOUBLE - i / 20) * 100 AS y, 20.0::DOUBLE AS w, i * 10.0::DOUBLE AS h FROM m, range(1, 3) t(i) WHERE i <= k % 3)"""


@BOOK.query(f"WITH {_COCO} SELECT id, k || '.jpg' AS file_name, 'license_plate' AS name, round(x, 6) AS x, round(y, 6) AS y, round(w * h, 6) AS area, CASE WHEN x < 0 OR x + w > 200 THEN 'outside' ELSE '' END AS errors FROM b")
def coco_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """A COCO document written as one file and read with its images and categories."""
    place = _place(spark, "coco")
    writers.write_texts(writers.coco_document(*_coco(spark, folder)).select(F.lit("train").alias("name"), F.col("document").alias("text")), place, ".json")
    rows = annotations.coco_boxes(annotations.read_coco(spark, f"{place}/train.json"))
    return rows.select("id", "file_name", "name", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), F.round("area", 6).alias("area"), F.array_join("errors", ";").alias("errors"))


@BOOK.query(f"""
WITH {_COCO} SELECT k || '.jpg' AS file_name, 'box' AS problem FROM b WHERE i = 1 AND k % 5 = 0 UNION ALL SELECT k || '.jpg', 'category' FROM b WHERE i = 2 AND k % 7 = 0 AND k % 5 <> 0
UNION ALL SELECT k || '.jpg', 'size' FROM s WHERE k % 4 = 1 UNION ALL SELECT k || '.jpg', 'category' FROM b WHERE i = 2 AND k % 7 = 0 AND k % 5 = 0
""")
def coco_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The document against tables with planted differences: moved boxes, other categories, other sizes."""
    images, rows = (materialize(d, "coco") for d in _coco(spark, folder))
    place = _place(spark, "coco")
    writers.write_texts(writers.coco_document(images, rows).select(F.lit("train").alias("name"), F.col("document").alias("text")), place, ".json")
    read = annotations.read_coco(spark, f"{place}/train.json")
    k = F.regexp_extract("file_name", r"^(\d+)", 1).cast("long")
    keyed = rows.join(images.select(F.col("id").alias("image_id"), k.alias("k")), "image_id").withColumn("first", F.col("area") < 300)
    bbox = F.when((F.col("k") % 5 == 0) & F.col("first"), F.transform("bbox", lambda v, n: v + F.when(n == 2, 0.5).otherwise(0.0))).otherwise(F.col("bbox"))
    moved = keyed.select("id", "image_id", F.when((F.col("k") % 7 == 0) & ~F.col("first"), 2).otherwise(F.col("category_id")).alias("category_id"), bbox.alias("bbox"), "area", "iscrowd", "segmentation")
    sized = images.withColumn("width", F.when(k % 4 == 1, 201).otherwise(F.col("width")))
    return annotations.coco_differences(read, sized, moved)


@BOOK.query("""SELECT p_partkey, 'a "quoted", ' || p_name AS p_name, p_retailprice FROM part WHERE p_size > 10""")
def csv_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """A CSV with quotes and separators in fields; types are pinned, columns pruned and found by name in any order."""
    place = _place(spark, "csv")
    rows = table(spark, folder, "part").withColumn("p_name", F.concat(F.lit('a "quoted", '), "p_name"))
    writers.write_csv(rows, place)
    return tables.read_csv(spark, place, "p_retailprice double, p_partkey bigint, p_size int, p_name string").where("p_size > 10").select("p_partkey", "p_name", "p_retailprice")


@BOOK.query("SELECT 'missing' AS source, 0::BIGINT AS row_count UNION ALL SELECT 'written', count(*) FROM nation UNION ALL SELECT 'bad_number', count(*) FROM nation WHERE n_nationkey % 5 = 0")
def csv_absences(spark: SparkSession, folder: str) -> DataFrame:
    """An absent CSV is no rows; a field that doesn't fit its pin is null where that is tolerated."""
    place = _place(spark, "csv")
    nations = table(spark, folder, "nation")
    writers.write_csv(nations.withColumn("n_nationkey", F.when(F.col("n_nationkey") % 5 == 0, "x").otherwise(F.col("n_nationkey").cast("string"))), place)
    absent = tables.read_csv(spark, f"{place}-none", "n_nationkey int", missing_ok=True)
    rows = tables.read_csv(spark, place, "n_nationkey int, n_name string", tolerant=True)
    count = lambda df, name: df.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("row_count"))
    return count(absent, "missing").unionByName(count(rows, "written")).unionByName(count(rows.where("n_nationkey is null"), "bad_number"))


@BOOK.query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)")
def wanted_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One scan of a large CSV for the rows of wanted ids."""
    place = _place(spark, "csv")
    writers.write_csv(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), place)
    index = tables.read_csv(spark, place, "o_orderkey bigint, o_custkey bigint")
    return tables.wanted_rows(index, table(spark, folder, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("o_custkey")), "o_custkey").select("o_orderkey", "o_custkey")


@BOOK.query("SELECT lower(c_name) AS key, c_mktsegment AS segment FROM customer")
def provenance_read(spark: SparkSession, folder: str) -> DataFrame:
    """Keys in upper case with blanks are one spelling after reading; they must be unique and filled."""
    place = _place(spark, "csv")
    writers.write_csv(table(spark, folder, "customer").select(F.concat(F.lit(" "), F.upper("c_name"), F.lit("  ")).alias("key"), F.col("c_mktsegment").alias("segment")), place)
    return tables.read_provenance(spark, place, "key", ["segment"])


@BOOK.query("SELECT n_name AS key, 'accepted' AS review_status FROM nation WHERE n_regionkey = 1")
def prior_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Earlier decisions from a file, and none from a file that isn't there."""
    place = _place(spark, "csv")
    writers.write_csv(table(spark, folder, "nation").where("n_regionkey = 1").select(F.col("n_name").alias("key"), F.lit("accepted").alias("review_status")), place)
    return tables.read_review(spark, place, "key").unionByName(tables.read_review(spark, f"{place}-none", "key"))


@BOOK.query("SELECT count(*) AS orders, round(sum(o_totalprice), 2) AS total, max(o_orderpriority) AS last_priority FROM orders")
def json_report(spark: SparkSession, folder: str) -> DataFrame:
    """A report of one row as a JSON file, read again with a schema."""
    place = _place(spark, "json")
    rows = table(spark, folder, "orders").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.max("o_orderpriority").alias("last_priority"))
    writers.write_report(rows, f"{place}/report.json")
    return tables.read_json(spark, f"{place}/report.json", "orders bigint, total double, last_priority string")


@BOOK.query("SELECT c_mktsegment AS split, c_name AS id FROM customer")
def split_id_lists(spark: SparkSession, folder: str) -> DataFrame:
    place = _place(spark, "ids")
    writers.write_id_lists(table(spark, folder, "customer"), "c_name", "c_mktsegment", place)
    return spark.read.text(place).select(F.col("c_mktsegment").alias("split"), F.col("value").alias("id"))


_LABELS = f"""{_KEYS}, t AS (SELECT k, coalesce(string_agg(printf('%d %.8f %.8f %.8f %.8f', 0, k % 24 / 20, 0.5::DOUBLE, 0.1::DOUBLE, i / 10), chr(10) ORDER BY i) || chr(10), '') AS text
  FROM s LEFT JOIN range(1, 3) r(i) ON i <= k % 3 GROUP BY k)"""


def _label_folder(spark: SparkSession, folder: str) -> str:
    """Labels of even keys in one folder below the place, of odd ones in another."""
    place, labels = _place(spark, "labels"), writers.yolo_labels(*_yolo(spark, folder), "k")
    writers.write_texts(labels.select(F.concat(F.when(F.col("k") % 2 == 0, "even/deep/").otherwise("odd/"), "k").alias("name"), "text"), place, ".TXT")
    return place


@BOOK.query(f"WITH {_LABELS} SELECT k AS image, '.txt' AS suffix, length(text) AS length, CASE WHEN k % 2 = 0 THEN 'deep' ELSE 'odd' END AS parent FROM t")
def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    """A recursive listing with sizes; files of no bytes are in it."""
    rows = files.list_files(spark, _label_folder(spark, folder), [".txt"], recursive=True)
    return rows.select(F.col("stem").cast("long").alias("image"), "suffix", "length", F.regexp_extract("path", "/([^/]+)/[^/]+$", 1).alias("parent"))


@BOOK.query(f"WITH {_LABELS} SELECT k AS image, upper(sha256(text)) AS sha256 FROM t")
def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    rows = files.digests(spark, _label_folder(spark, folder), recursive=True, upper=True)
    return rows.select(F.col("stem").cast("long").alias("image"), "sha256")


@BOOK.query(f"WITH {_KEYS} SELECT count(*) AS files, 'odd' AS marker, true AS below_root FROM s")
def unique_root(spark: SparkSession, folder: str) -> DataFrame:
    """The only folder that holds a folder of a name, found in a listing of everything below."""
    place = _label_folder(spark, folder)
    listed = files.list_files(spark, place, recursive=True)
    root = files.unique_root(listed, "odd")
    return listed.agg(F.count(F.lit(1)).alias("files"), F.lit("odd").alias("marker"), F.lit(root.endswith(place.rsplit("/", 1)[1])).alias("below_root"))


_HEX = f"{_KEYS} SELECT k AS number, k % 4 <> 0 AS has_id, CASE WHEN k % 4 <> 0 THEN printf('%016x', k) END AS image_id FROM s"


@BOOK.query(f"WITH {_HEX}")
def id_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Files whose name is an id of 16 hex digits, in either case, and the others."""
    place = _place(spark, "inventory")
    name = F.when(F.col("k") % 4 == 0, F.concat(F.lit("note_"), "k")).otherwise(F.format_string("%016X", "k"))
    writers.write_texts(_images(spark, folder).select(name.alias("name"), F.col("k").cast("string").alias("text")), place, ".jpg")
    good, other = files.inventory(files.list_files(spark, place))
    number = lambda c: F.conv(F.regexp_replace(c, "^note_", ""), 16, 10).cast("long")
    good = good.select(number(F.col("stem")).alias("number"), F.lit(True).alias("has_id"), "image_id")
    return good.unionByName(other.select(F.regexp_extract("stem", r"(\d+)$", 1).cast("long").alias("number"), F.lit(False).alias("has_id"), F.lit(None).cast("string").alias("image_id")))


@BOOK.query(f"WITH {_KEYS} SELECT k AS image, CASE WHEN k % 5 = 0 THEN 'a/' || k || '.jpg' WHEN k % 2 = 0 THEN 'a/' || k || '.png' WHEN k % 3 = 0 THEN 'b/' || k || '.jpg' END AS found FROM s")
def resolved_images(spark: SparkSession, folder: str) -> DataFrame:
    """The first existing file of each image, folders before suffixes."""
    place, k = _place(spark, "resolve"), F.col("k")
    names = F.array_compact(F.array(F.when(k % 2 == 0, F.concat(F.lit("a/"), k, F.lit(".png"))), F.when(k % 3 == 0, F.concat(F.lit("b/"), k, F.lit(".jpg"))), F.when(k % 5 == 0, F.concat(F.lit("a/"), k, F.lit(".jpg")))))
    images = _images(spark, folder)
    put_files(images.select(F.explode(names).alias("name"), F.encode(F.lit("x"), "UTF-8").alias("data")), place)
    listed = files.list_files(spark, place, recursive=True)
    path = store(place)[1]
    rows = files.resolve(images.select(k.cast("string").alias("stem")), listed, [f"{path}/a", f"{path}/b"], [".jpg", ".png"])
    return rows.select(F.col("stem").cast("long").alias("image"), F.regexp_extract("path", "([ab]/[^/]+)$", 1).alias("found")).withColumn("found", F.nullif("found", F.lit("")))


@BOOK.query(f"WITH {_KEYS} SELECT k AS stem, f AS folder, CASE f WHEN 'a' THEN k % 2 = 0 WHEN 'b' THEN k % 3 = 0 ELSE false END AS present FROM s, (VALUES ('a'), ('b'), ('c')) t(f)")
def replica_presence(spark: SparkSession, folder: str) -> DataFrame:
    """For each image and folder whether a copy is there."""
    images = _images(spark, folder)
    have = images.where("k % 2 = 0").select(F.col("k").alias("stem"), F.lit("a").alias("folder")).unionByName(images.where("k % 3 = 0").select(F.col("k").alias("stem"), F.lit("b").alias("folder")))
    return replica_check(images.select(F.col("k").alias("stem")), have, "stem", "folder", ["a", "b", "c"])


def _bitmaps(rows: DataFrame, size: tuple[int, int] | None = None, rough: bool = False) -> DataFrame:
    """``name, data``: small bitmap files of computed pixels, of one ``size`` or of several with some broken and some of no bytes; ``rough`` ones have no period."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for b in batches:
            names, data = [], []
            for k in b.column(0).to_pylist():
                w, h = size or (8 + k % 5, 6 + k % 3)
                i = np.arange(w * h * 3)
                rgb = ((k * 7 + i) * (i * 17 + k + 1) % 251 if rough else (k * 7 + i) * 13 % 256).astype(np.uint8).reshape(h, w, 3)
                lines = b"".join(x[:, ::-1].tobytes() + bytes(-3 * w % 4) for x in rgb[::-1])
                head = b"BM" + (54 + len(lines)).to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little")
                info = (40).to_bytes(4, "little") + w.to_bytes(4, "little") + h.to_bytes(4, "little") + (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + bytes(24)
                names.append(f"{k}.bmp")
                data.append(b"no picture" if k % 8 == 0 and not size else b"" if k % 9 == 0 and not size else head + info + lines)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(data, pa.binary())], ["name", "data"])

    return rows.select("k").mapInArrow(scan, "name string, data binary")


def _bitmap_folder(spark: SparkSession, folder: str) -> str:
    place = _place(spark, "bitmaps")
    put_files(_bitmaps(_images(spark, folder)), place)
    writers.write_texts(_images(spark, folder).select(F.lit("index").alias("name"), F.lit("no image").alias("text")).limit(1), place, ".csv")
    return place


@BOOK.query(f"WITH {_KEYS} SELECT k AS image, k % 8 = 0 OR k % 9 = 0 AS corrupt, CASE WHEN k % 8 > 0 AND k % 9 > 0 THEN 8 + k % 5 END AS width, CASE WHEN k % 8 > 0 AND k % 9 > 0 THEN 6 + k % 3 END AS height FROM s")
def image_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of decoded images; broken files and files of no bytes are corrupt, and other files are no images."""
    rows = files.images(spark, _bitmap_folder(spark, folder))
    return rows.select(F.regexp_extract("path", r"(\d+)\.bmp$", 1).cast("long").alias("image"), "corrupt", *(F.col(c).cast("long").alias(c) for c in ("width", "height")))


@BOOK.query(f"""
WITH {_KEYS}, g AS (SELECT k, 8 + k % 5 AS w, 6 + k % 3 AS h FROM s WHERE k % 8 > 0 AND k % 9 > 0), v AS (SELECT k, w, h, i, (k * 7 + i) * 13 % 256 AS v FROM g, range(308) t(i) WHERE i < w * h * 3)
SELECT k AS image, sha256(unhex(printf('%02x000000%02x000000', any_value(w), any_value(h)) || string_agg(printf('%02x', v), '' ORDER BY i))) AS pixel_sha256, min(v) AS pixel_min, max(v) AS pixel_max,
  round(avg(v), 6) AS pixel_mean, round(stddev_pop(v), 6) AS pixel_std, stddev_pop(v) <= 1 AS near_uniform FROM v GROUP BY k
""")
def pixel_prints(spark: SparkSession, folder: str) -> DataFrame:
    """Digest and statistics of the pixels of decoded images."""
    prints = files.pixel_flags(files.fingerprints(files.images(spark, _bitmap_folder(spark, folder))))
    return prints.select(F.regexp_extract("path", r"(\d+)\.bmp$", 1).cast("long").alias("image"), "pixel_sha256", *(F.col(c).cast("long").alias(c) for c in ("pixel_min", "pixel_max")), F.round("pixel_mean", 6).alias("pixel_mean"), F.round("pixel_std", 6).alias("pixel_std"), "near_uniform")


@BOOK.query(f"""
WITH {_KEYS}, v AS (SELECT k, i, (k * 7 + i) * 13 % 256 AS v FROM s, range(216) t(i)), p AS (SELECT k, i // 3 AS at, round_even(sum(v * CASE i % 3 WHEN 0 THEN 0.299::DOUBLE WHEN 1 THEN 0.587 ELSE 0.114 END), 0) AS grey FROM v GROUP BY 1, 2),
b AS (SELECT a.k, a.at // 9 * 8 + a.at % 9 AS bit, b.grey > a.grey AS up FROM p a JOIN p b ON b.k = a.k AND b.at = a.at + 1 WHERE a.at % 9 < 8)
SELECT k AS image, sum(CASE WHEN up THEN 1::HUGEINT << (63 - bit)::INTEGER ELSE 0 END)::UBIGINT::VARCHAR AS dhash FROM b GROUP BY k
""")
def difference_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """The hash of brightness steps, of images that have the size it is taken at."""
    place = _place(spark, "bitmaps")
    put_files(_bitmaps(_images(spark, folder), (9, 8)), place)
    prints = files.fingerprints(files.images(spark, place))
    return prints.select(F.regexp_extract("path", r"(\d+)\.bmp$", 1).cast("long").alias("image"), F.conv(F.hex("dhash"), 16, 10).alias("dhash"))


@BOOK.query(f"""
WITH {_KEYS}, v AS (SELECT k, i, (k * 7 + i) * (i * 17 + k + 1) % 251 AS v FROM s, range(3072) t(i)), p AS (SELECT k, i // 96 AS y, i // 3 % 32 AS x, round_even(sum(v * CASE i % 3 WHEN 0 THEN 0.299::DOUBLE WHEN 1 THEN 0.587 ELSE 0.114 END), 0) AS grey FROM v GROUP BY ALL),
c AS (SELECT u, n, cos(pi() * (2 * n + 1) * u / 64) * sqrt(2.0::DOUBLE / 32) / CASE WHEN u = 0 THEN sqrt(2.0::DOUBLE) ELSE 1 END AS w FROM range(8) a(u), range(32) b(n)),
r AS (SELECT k, u, x, sum(grey * w) AS f FROM p JOIN c ON n = y GROUP BY ALL), q AS (SELECT k, r.u * 8 + c.u AS bit, sum(f * w) AS f FROM r JOIN c ON n = x GROUP BY ALL),
m AS (SELECT k, list_sort(list(f) FILTER (bit > 0))[32] AS middle FROM q GROUP BY k)
SELECT k AS image, sum(CASE WHEN f > middle THEN 1::HUGEINT << (63 - bit)::INTEGER ELSE 0 END)::UBIGINT::VARCHAR AS phash FROM q JOIN m USING (k) GROUP BY k
""")
def cosine_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """The hash of the lowest cosine coefficients, of images that have the size it is taken at."""
    place = _place(spark, "bitmaps")
    put_files(_bitmaps(_images(spark, folder), (32, 32), rough=True), place)
    prints = files.fingerprints(files.images(spark, place))
    return prints.select(F.regexp_extract("path", r"(\d+)\.bmp$", 1).cast("long").alias("image"), F.conv(F.hex("phash"), 16, 10).alias("phash"))


@BOOK.query(f"WITH {_LABELS} SELECT 'img_' || k || '.txt' AS name, sha256(text) AS sha256 FROM t")
def copied_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files copied under their canonical names, extensions in lower case."""
    source, pool = _label_folder(spark, folder), _place(spark, "pool")
    listed = files.list_files(spark, source, recursive=True).select(F.concat(F.lit("img_"), "stem").alias("id"), "path")
    writers.run_copies(writers.copy_plan(listed, "id", "path", pool))
    return files.digests(spark, pool).select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "sha256")


@BOOK.query(f"""WITH {_KEYS} SELECT k AS image, p AS problem FROM (
SELECT k, unnest(list_filter([CASE WHEN k % 10 = 1 THEN 'missing' END, CASE WHEN k % 10 = 2 THEN 'changed' END, CASE WHEN k % 10 = 3 THEN 'nested' END, CASE WHEN k % 10 = 4 THEN 'extension' END, CASE WHEN k % 10 = 5 THEN 'repeated' END, CASE WHEN k % 10 = 6 THEN 'unexpected' END], lambda x: x IS NOT NULL)) AS p FROM s)""")
def physical_identity(spark: SparkSession, folder: str) -> DataFrame:
    """A manifest against its files, with every kind of problem planted: all are collected."""
    place, k = _place(spark, "pool"), F.col("k")
    text = F.concat(F.lit("label "), k, F.when(k % 10 == 2, "!").otherwise(""))
    name = F.concat(F.when(k % 10 == 3, "more/").otherwise(""), k.cast("string"), F.when(k % 10 == 4, ".dat").otherwise(".txt"))
    images = _images(spark, folder)
    names = images.where("k % 10 <> 1").select(F.explode(F.array_compact(F.array(name, F.when(k % 10 == 5, F.concat(F.lit("again/"), k, F.lit(".txt")))))).alias("name"), F.encode(text, "UTF-8").alias("data"))
    put_files(names.where("name not like 'again/%'").unionByName(names.where("name like 'again/%'").withColumn("name", F.regexp_replace("name", r"again/(\d+)\.txt", "$1.TXT"))), place)
    manifest = images.where("k % 10 <> 6").select(k.alias("image"), F.sha2(F.concat(F.lit("label "), k.cast("string")), 256).alias("sha256"))
    problems = physical_problems(manifest, files.digests(spark, place, recursive=True), "image", "sha256", place, [".txt"])
    return problems.select(F.col("image").cast("long").alias("image"), "problem")


@BOOK.query("SELECT c_custkey, 'CC-BY' AS licence, 2 AS version FROM customer UNION ALL SELECT c_custkey, NULL, 1 FROM customer")
def versioned_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """A table rewritten with a constant column as a next version; the first stays."""
    place = _place(spark, "versions")
    writers.write_version(table(spark, folder, "customer").select("c_custkey", F.lit(None).cast("string").alias("licence")), place)
    number = writers.write_version(writers.with_constants(writers.read_version(spark, place), licence="CC-BY"), place)
    return writers.read_version(spark, place).withColumn("version", F.lit(number)).unionByName(writers.read_version(spark, place, 1).withColumn("version", F.lit(1)))


@BOOK.query("SELECT count(*) AS row_count, true AS refused FROM region")
def written_once(spark: SparkSession, folder: str) -> DataFrame:
    """The second write to one path is refused and changes nothing."""
    place, refused = _place(spark, "once"), False
    writers.write_once(table(spark, folder, "region"), place)
    try:
        writers.write_once(table(spark, folder, "region").limit(1), place)
    except Exception as e:  # noqa: BLE001
        refused = "exist" in str(e).lower()
    return spark.read.parquet(place).agg(F.count(F.lit(1)).alias("row_count"), F.lit(refused).alias("refused"))


@BOOK.query("""
SELECT count(*) AS row_count, coalesce(sum(('0x' || substr(sha256('{"doc_id":' || doc_id || coalesce(',"n_chars":' || n_chars, '') || '}'), 1, 15))::BIGINT), 0)::VARCHAR AS digest FROM documents
""")
def table_digests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").agg(*table_digest("doc_id", "n_chars"))


@BOOK.query(f"WITH {_KEYS} SELECT k AS image, CASE WHEN k % 3 = 0 THEN NULL ELSE k % 2 + 1 END AS bytes, k % 3 = 0 AS failed FROM s")
def fetched_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One fetch for each row on the executors, tried again; failures are rows, not exceptions."""
    place = _place(spark, "fetch")
    images = _images(spark, folder)
    writers.write_texts(images.where("k % 3 <> 0").select(F.col("k").alias("name"), F.repeat(F.lit("x"), (F.col("k") % 2 + 1).cast("int")).alias("text")), place, ".bin")

    def fetch(url: str) -> bytes:
        system, path, _ = store(url)
        with system.open_input_stream(path) as data:
            return data.read()

    got = tables.fetch_rows(images.withColumn("url", F.concat(F.lit(f"{place}/"), "k", F.lit(".bin"))), "k", "url", fetch, tries=2, pause=0.0)
    return got.select(F.col("k").alias("image"), F.length("bytes").cast("long").alias("bytes"), F.col("error").isNotNull().alias("failed"))


@BOOK.query("SELECT 'second' AS version, count(*) AS row_count FROM nation")
def swapped_folder(spark: SparkSession, folder: str) -> DataFrame:
    """A folder replaced as a whole: a build that fails its check leaves the one before."""
    place = _place(spark, "swap")
    build = lambda n, name: lambda path: table(spark, folder, "nation").limit(n).withColumn("version", F.lit(name)).write.parquet(path)

    def whole(path: str) -> None:
        if spark.read.parquet(path).count() < 25:
            raise ContractError("not all nations")

    writers.swap_folder(build(25, "first"), f"{place}/pool", whole)
    writers.swap_folder(build(25, "second"), f"{place}/pool", whole)
    try:
        writers.swap_folder(build(3, "third"), f"{place}/pool", whole)
    except ContractError:
        pass
    return spark.read.parquet(f"{place}/pool").groupBy("version").agg(F.count(F.lit(1)).alias("row_count"))


@BOOK.query("SELECT s AS name, CASE WHEN s = 'test_2' THEN 'old' ELSE 'new' END || (SELECT count(*) FROM region)::VARCHAR AS text FROM (VALUES ('train'), ('test'), ('test_2')) t(s)")
def committed_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Several files replaced all or none, and a copy of one with a time in its name made before."""
    import datetime

    place, n = _place(spark, "commit"), table(spark, folder, "region").count()
    put_files(spark.createDataFrame([(f"{x}.txt", f"old{n}".encode()) for x in ("train", "test")], "name string, data binary"), place)
    kept = writers.backup(f"{place}/test.txt", datetime.datetime(2024, 1, 2))
    writers.commit_texts({f"{place}/{x}.txt": f"new{n}" for x in ("train", "test")})
    try:
        writers.commit_texts({f"{place}/train.txt": "lost", f"{place}/none/x.txt": "lost"})
    except OSError:
        pass
    assert kept.endswith("test_20240102_000000.txt")
    rows = files.list_files(spark, place, [".txt"], content=True)
    return rows.select(F.regexp_replace("stem", "_2024.*$", "_2").alias("name"), F.decode("content", "UTF-8").alias("text"))


@BOOK.query("SELECT 3 AS attempts, string_agg(r_name, ';' ORDER BY r_name) AS text FROM region")
def cached_download(spark: SparkSession, folder: str) -> DataFrame:
    """A file fetched after two failures, and not again once it is there; no partial file stays."""
    place, calls = _place(spark, "download"), []
    names = table(spark, folder, "region").agg(F.array_join(F.array_sort(F.collect_set("r_name")), ";").alias("text"))
    writers.write_texts(names.select(F.lit("index").alias("name"), "text"), f"{place}/far", ".txt")

    def opener(url: str, timeout: float):
        calls.append(url)
        if len(calls) < 3:
            raise OSError("down")
        system, path, _ = store(url)
        return system.open_input_stream(path)

    for _ in range(2):
        tables.download(f"{place}/far/index.txt", f"{place}/index.txt", opener=opener, wait=lambda _: None)
    rows = files.list_files(spark, place, content=True)
    return rows.select(F.lit(len(calls)).alias("attempts"), F.decode("content", "UTF-8").alias("text"))
