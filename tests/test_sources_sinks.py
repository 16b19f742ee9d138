import json
import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatrix.contracts import ContractError
from curatrix.sinks import writers as out
from curatrix.sources import annotations as ann
from curatrix.sources import files as fs
from curatrix.sources import tables as tb


def png(rgb: np.ndarray) -> bytes:
    h, w, _ = rgb.shape
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    raw = b"".join(b"\0" + row.tobytes() for row in rgb)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture()
def pictures(tmp_path):
    r = np.random.default_rng(1)
    a = r.integers(0, 255, (48, 64, 3), dtype=np.uint8)
    smooth = np.repeat(np.repeat(r.integers(0, 255, (8, 8, 3), dtype=np.uint8), 20, 0), 20, 1)
    for name, data in (("a.png", a), ("a2.png", a), ("smooth.png", smooth), ("small.png", smooth[::2, ::2]), ("black.png", np.zeros((20, 20, 3), np.uint8))):
        (tmp_path / name).write_bytes(png(data))
    (tmp_path / "broken.png").write_bytes(b"no picture")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "0123456789abcdef.JPG").write_bytes(b"x")
    return tmp_path, a


def test_images_and_fingerprints(spark, pictures):
    import hashlib

    folder, a = pictures
    rows = fs.images(spark, str(folder))
    assert {os.path.basename(r["path"]): r["corrupt"] for r in rows.collect()}["broken.png"]
    prints = {os.path.basename(r["path"]): r for r in fs.pixel_flags(fs.fingerprints(rows)).collect()}
    assert len(prints) == 5
    want = hashlib.sha256((64).to_bytes(4, "little") + (48).to_bytes(4, "little") + a.tobytes()).hexdigest()
    assert prints["a.png"]["pixel_sha256"] == prints["a2.png"]["pixel_sha256"] == want
    assert prints["black.png"]["all_black"] and prints["black.png"]["near_uniform"] and not prints["a.png"]["near_black"]
    assert prints["a.png"]["pixel_std"] == pytest.approx(a.std())
    p, q = prints["smooth.png"], prints["small.png"]
    assert (p["phash"] ^ q["phash"]).bit_count() <= 8 and (p["dhash"] ^ q["dhash"]).bit_count() <= 10
    assert ((prints["a.png"]["phash"] ^ p["phash"]) % (1 << 64)).bit_count() > 8


def test_listing(spark, pictures):
    folder, _ = pictures
    flat = fs.list_files(spark, str(folder), [".png"])
    assert {r["stem"] for r in flat.collect()} == {"a", "a2", "smooth", "small", "black", "broken"}
    deep = fs.list_files(spark, str(folder), fs.IMAGE_SUFFIXES, recursive=True)
    ids, others = fs.inventory(deep)
    assert [r["image_id"] for r in ids.collect()] == ["0123456789abcdef"] and others.count() == 6
    assert fs.by_stem(flat).count() == 6
    d = {r["stem"]: r["sha256"] for r in fs.digests(spark, str(folder), [".png"]).collect()}
    assert d["a"] == d["a2"] != d["black"]
    want = spark.createDataFrame([("a",), ("zzz",)], "stem string")
    got = {r["stem"]: r["path"] for r in fs.resolve(want, flat, [f"{folder}/none", str(folder)], [".jpg", ".png"]).collect()}
    assert got == {"a": f"{folder}/a.png", "zzz": None}
    assert fs.unique_root(deep, "sub").endswith(folder.name)
    with pytest.raises(ContractError):
        fs.unique_root(deep, "nothing")


VOC = "<annotation><filename>{f}</filename><size><width>100</width><height>50</height></size>{o}</annotation>"
OBJ = "<object><name>plate</name><bndbox><xmin>{}</xmin><ymin>{}</ymin><xmax>{}</xmax><ymax>{}</ymax></bndbox></object>"


def test_voc(spark, tmp_path):
    (tmp_path / "a.xml").write_text(VOC.format(f="a.jpg", o=OBJ.format(1, 2, 30, 40) + OBJ.format(30, 2, 10, 60)))
    (tmp_path / "b.xml").write_text(VOC.format(f="b.jpg", o=""))
    (tmp_path / "c.xml").write_text("not xml at all")
    rows = {(r["stem"], r["box_index"]): r for r in ann.read_voc(spark, str(tmp_path)).collect()}
    assert rows["a", 1]["errors"] == [] and (rows["a", 1]["xmax"], rows["a", 1]["width"]) == (30.0, 100)
    assert rows["a", 2]["errors"] == ["inverted", "outside"]
    assert rows["b", None]["errors"] == [] and rows["b", None]["name"] is None
    assert rows["c", None]["errors"] == ["unreadable"]
    assert ann.read_voc(spark, str(tmp_path), "skip").count() == 2
    with pytest.raises(ContractError):
        ann.read_voc(spark, str(tmp_path), "raise")


def test_yolo(spark, tmp_path):
    (tmp_path / "a.txt").write_text("0 0.5 0.5 0.2 0.2\n\n1 0.9 0.5 0.4\nx 0.5 0.5 0.1 0.1\r\n0 1.5 0.5 0.1 0\n")
    (tmp_path / "b.txt").write_text("")
    rows = {(r["stem"], r["line_number"]): r for r in ann.read_yolo(spark, str(tmp_path)).collect()}
    assert {k: v["errors"] for k, v in rows.items()} == {("a", 1): [], ("a", 3): ["tokens"], ("a", 4): ["not_a_number"], ("a", 5): ["centre", "size"], ("b", None): []}
    assert ann.read_yolo(spark, str(tmp_path), "skip").where("line_number is not null").count() == 1


def test_coco_round_trip(spark, tmp_path):
    samples = spark.createDataFrame([("b", "b.jpg", 200, 100), ("a", "a.jpg", 100, 100)], "canonical_id string, file_name string, width int, height int")
    boxes = spark.createDataFrame([("b", 2, 0.5, 0.5, 0.1, 0.2), ("b", 1, 0.25, 0.5, 0.5, 1.0)], "canonical_id string, box_index int, x_center double, y_center double, width double, height double")
    images, annotations = out.coco_tables(samples, boxes)
    text = out.coco_document(images, annotations).first()[0]
    (tmp_path / "train.json").write_text(text)
    doc = json.loads(text)
    assert [i["file_name"] for i in doc["images"]] == ["a.jpg", "b.jpg"] and [a["id"] for a in doc["annotations"]] == [1, 2]
    tables = ann.read_coco(spark, str(tmp_path / "train.json"))
    back = ann.coco_boxes(tables).orderBy("id").collect()
    assert [(r["file_name"], round(r["x"], 6), round(r["w"], 6), r["errors"], r["name"]) for r in back] == [("b.jpg", 0.0, 100.0, [], "license_plate"), ("b.jpg", 90.0, 20.0, [], "license_plate")]
    assert ann.coco_differences(tables, images, annotations).count() == 0
    moved = tables | {"annotations": tables["annotations"].withColumn("x", F.col("x") + F.when(F.col("id") == 2, 0.01).otherwise(0.0)), "images": tables["images"].where("id > 1").withColumn("width", F.lit(7))}
    assert {tuple(r) for r in ann.coco_differences(moved, images, annotations).collect()} == {("a.jpg", "missing"), ("b.jpg", "size"), ("b.jpg", "box")}
    labels = {r["canonical_id"]: r["text"] for r in out.yolo_labels(samples, boxes.withColumn("class_id", F.lit(0)), "canonical_id").collect()}
    assert labels == {"a": "", "b": "0 0.25000000 0.50000000 0.50000000 1.00000000\n0 0.50000000 0.50000000 0.10000000 0.20000000\n"}


def test_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text('﻿ImageID,text,n\n00e1,"two\nlines ""q""",1\n0123,,x\n')
    rows = tb.read_csv(spark, str(tmp_path / "r.csv"), "n int, ImageID string, text string", multi_line=True, tolerant=True).collect()
    assert [tuple(r) for r in rows] == [(1, "00e1", 'two\nlines "q"'), (None, "0123", None)]
    with pytest.raises(Exception, match="n is not int: x"):
        tb.read_csv(spark, str(tmp_path / "r.csv"), "n int, ImageID string, text string", multi_line=True).collect()
    assert tb.read_csv(spark, str(tmp_path / "r.csv")).dtypes == [("ImageID", "string"), ("text", "string"), ("n", "string")]
    assert tb.read_csv(spark, str(tmp_path / "no.csv"), "a int", missing_ok=True).count() == 0
    (tmp_path / "head.csv").write_text("ImageID,License\n")
    assert tb.read_provenance(spark, str(tmp_path / "head.csv"), "ImageID", ["License"]).count() == 0
    with pytest.raises(ContractError):
        tb.read_csv(spark, str(tmp_path / "r.csv"), "missing int")
    (tmp_path / "dup.csv").write_text("ImageID,License\nA,x\n a ,y\n")
    with pytest.raises(ContractError):
        tb.read_provenance(spark, str(tmp_path / "dup.csv"), "ImageID", ["License"])
    (tmp_path / "map.csv").write_text("/m/1,Car\n/m/2,Bus\n")
    names = tb.read_csv(spark, str(tmp_path / "map.csv"), "mid string, name string", header=False)
    assert tb.wanted_rows(names, spark.createDataFrame([("/m/2",)], "mid string"), "mid").count() == 1
    assert tb.read_review(spark, str(tmp_path / "none.csv"), "k").columns == ["k", "review_status"]


def test_download(tmp_path):
    class Body:
        def __init__(self):
            self.left = [b"abc", b""]

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

        def read(self, _):
            return self.left.pop(0)

    calls, waits = [], []

    def opener(url, timeout):
        calls.append(url)
        if len(calls) < 3:
            raise OSError("down")
        return Body()

    path = str(tmp_path / "f")
    assert tb.download("u", path, opener=opener, wait=waits.append) == path and open(path).read() == "abc" and waits == [1, 2]
    tb.download("u", path, opener=opener)
    assert len(calls) == 3
    with pytest.raises(ContractError):
        tb.download("u", path + "2", tries=2, opener=lambda *_, **__: (_ for _ in ()).throw(OSError("no")), wait=waits.append)


def test_fetch_collects_failures(spark):
    rows = spark.createDataFrame([("a", "good"), ("b", "bad")], "key string, url string")

    def fetch(url):
        if url == "bad":
            raise ValueError("gone")
        return b"data"

    got = {r["key"]: (r["bytes"], r["error"]) for r in tb.fetch_rows(rows, "key", "url", fetch).collect()}
    assert got == {"a": (bytearray(b"data"), None), "b": (None, "ValueError: gone")}


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("b", "train", ["x", "y"]), ("a", "train", []), ("c", "val", None)], "id string, split string, tags array<string>")
    out.write_csv(df, str(tmp_path / "csv"))
    back = {r["id"]: r["tags"] for r in tb.read_csv(spark, str(tmp_path / "csv")).collect()}
    assert back["b"] == "x;y" and not back["c"]
    out.write_once(df, str(tmp_path / "once"))
    with pytest.raises(Exception, match="exist"):
        out.write_once(df, str(tmp_path / "once"))
    out.write_id_lists(df, "id", "split", str(tmp_path / "ids"))
    lists = {r["split"]: sorted(r["v"]) for r in spark.read.text(str(tmp_path / "ids")).groupBy("split").agg(F.collect_list("value").alias("v")).collect()}
    assert lists == {"train": ["a", "b"], "val": ["c"]}
    report = out.write_report(df.agg(F.count("*").alias("n")), str(tmp_path / "r.json"))
    assert report == json.loads((tmp_path / "r.json").read_text()) == {"n": 3}
    labels = spark.createDataFrame([("a", "0 1\n"), ("b", "")], "id string, text string")
    out.write_yolo(labels, "id", str(tmp_path / "labels"))
    assert (tmp_path / "labels" / "b.txt").read_text() == "" and (tmp_path / "labels" / "a.txt").read_text() == "0 1\n"
    (tmp_path / "src.JPG").write_bytes(b"img")
    plan = out.copy_plan(spark.createDataFrame([("k1", str(tmp_path / "src.JPG"))], "id string, path string"), "id", "path", str(tmp_path / "pool"))
    out.run_copies(plan)
    assert (tmp_path / "pool" / "k1.jpg").read_bytes() == b"img"
    assert out.with_constants(df, licence="x").columns[-1] == "licence"


def test_all_or_nothing(tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.write_text("old")
    out.commit_texts({str(a): "new", str(b): "more"})
    assert (a.read_text(), b.read_text()) == ("new", "more")
    with pytest.raises(OSError):
        out.commit_texts({str(a): "newer", str(tmp_path / "no" / "x"): "more"})
    assert a.read_text() == "new" and sorted(os.listdir(tmp_path)) == ["a", "b"]
    assert out.backup(str(tmp_path / "none")) is None
    assert open(out.backup(str(a))).read() == "new"


def test_swap(tmp_path):
    target = str(tmp_path / "pool")

    def build(text):
        def make(folder):
            os.mkdir(folder)
            open(os.path.join(folder, "f"), "w").write(text)

        return make

    def check(folder):
        if open(os.path.join(folder, "f")).read() == "bad" and folder == target:
            raise ContractError("bad")

    out.swap_folder(build("one"), target)
    out.swap_folder(build("two"), target, check)
    with pytest.raises(ContractError):
        out.swap_folder(build("bad"), target, check)
    assert open(os.path.join(target, "f")).read() == "two" and os.listdir(tmp_path) == ["pool"]


def test_files_of_no_bytes_are_listed_and_corrupt(spark, tmp_path):
    (tmp_path / "empty.png").write_bytes(b"")
    (tmp_path / "table.csv").write_text("a,b\n")
    (tmp_path / "good.png").write_bytes(png(np.zeros((4, 4, 3), np.uint8)))
    assert {(r["stem"], r["length"] > 0) for r in fs.list_files(spark, str(tmp_path)).collect()} == {("empty", False), ("table", True), ("good", True)}
    assert {os.path.basename(r["path"]): r["corrupt"] for r in fs.images(spark, str(tmp_path)).collect()} == {"empty.png": True, "good.png": False}
    assert {r["stem"]: bytes(r["content"]) for r in fs.list_files(spark, str(tmp_path), [".csv", ".png"], content=True).collect()}["empty"] == b""
    assert fs.list_files(spark, str(tmp_path / "none"), recursive=True).count() == 0
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "e.xml").write_text("")
    assert [(r["stem"], r["errors"]) for r in ann.read_voc(spark, str(tmp_path / "only")).collect()] == [("e", ["unreadable"])]
    assert fs.images(spark, str(tmp_path / "only")).count() == 0


def test_versions_and_stale_labels(spark, tmp_path):
    place = str(tmp_path / "t")
    with pytest.raises(ContractError):
        out.read_version(spark, place)
    assert out.write_version(spark.range(3), place) == 1
    assert out.write_version(out.read_version(spark, place).where("id > 0"), place) == 2
    os.remove(f"{place}/version=2/_SUCCESS")  # not whole
    assert out.read_version(spark, place).count() == 3
    assert out.write_version(spark.range(9), place) == 2 and out.read_version(spark, place).count() == 9
    labels = spark.createDataFrame([("a", "1\n"), ("b", None)], "k string, text string")
    out.write_yolo(labels, "k", str(tmp_path / "l"))
    out.write_yolo(labels.where("k = 'b'"), "k", str(tmp_path / "l"))
    assert os.listdir(tmp_path / "l") == ["b.txt"]


def test_fetch_tries_again(spark):
    class Flaky:
        seen: dict = {}

        def __call__(self, url):
            self.seen[url] = self.seen.get(url, 0) + 1
            if self.seen[url] < 3:
                raise OSError("down")
            return b"x"

    rows = spark.createDataFrame([("a", "u")], "key string, url string").coalesce(1)
    assert tb.fetch_rows(rows, "key", "url", Flaky(), tries=3, pause=0.0).first()["bytes"] == b"x"
    assert tb.fetch_rows(rows, "key", "url", Flaky(), tries=2, pause=0.0).first()["error"] == "OSError: down"


def test_shared_folder_needs_a_setting_on_a_cluster():
    from curatrix import session

    class Fake:
        class conf:
            @staticmethod
            def get(*_):
                return None

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Fake)
