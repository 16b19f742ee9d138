"""Writers and the staging, versioning and write-once rules around them."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from datetime import datetime

from pyarrow.fs import FileSelector, LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.contracts import ContractError
from curatrix.functions.geometry import centre_to_pixels
from curatrix.operators.ranks import global_positions
from curatrix.sources.storage import copy, exists, move, put, put_files, remove, remove_files, store


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header and doubled quotes; arrays are joined by ``;`` and nulls are empty."""
    flat = [F.array_join(F.transform(c, lambda x: x.cast("string")), ";").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_once(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Fails if the path exists."""
    df.write.mode("errorifexists").format(fmt).save(path)


def write_report(df: DataFrame, path: str) -> dict:
    """A table of one row as an indented JSON file at a path or URI; returns it."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ContractError("a report has one row")
    report = rows[0].asDict(recursive=True)
    put(path, (json.dumps(report, indent=2, ensure_ascii=False, default=str) + "\n").encode())
    return report


def write_id_lists(df: DataFrame, key: str, split: str, path: str) -> None:
    """Ids of each split as text, one a line, sorted within files, in folders ``<split>=<name>``."""
    df.where(F.col(split).isNotNull()).select(split, F.col(key).cast("string").alias("value")).repartitionByRange(split, "value").sortWithinPartitions(split, "value").write.mode("errorifexists").partitionBy(split).text(path)


def yolo_line(class_id: Column, cx: Column, cy: Column, w: Column, h: Column) -> Column:
    return F.printf(F.lit("%d %.8f %.8f %.8f %.8f"), class_id, cx, cy, w, h)


def yolo_labels(images: DataFrame, boxes: DataFrame, key: str) -> DataFrame:
    """``key, text``: the label file of every image, lines by ``box_index``; images without boxes have an empty text."""
    line = yolo_line(*(F.col(c) for c in ("class_id", "x_center", "y_center", "width", "height")))
    per = boxes.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("box_index", line.alias("line")))).alias("l"))
    text = F.concat(F.array_join(F.transform("l", lambda x: x["line"]), "\n"), F.lit("\n"))
    return images.select(key).distinct().join(per, key, "left").select(key, F.coalesce(text, F.lit("")).alias("text"))


def write_texts(rows: DataFrame, folder: str, extension: str) -> None:
    """One file for each row of ``name, text``, in UTF-8, written by the executors through the folder's file system."""
    put_files(rows.select(F.concat(F.col("name").cast("string"), F.lit(extension)).alias("name"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data")), folder)


def write_yolo(labels: DataFrame, key: str, folder: str) -> None:
    """One label file a row; label files of an earlier run that no row names are removed afterwards."""
    from curatrix.sources.files import list_files

    write_texts(labels.select(F.col(key).alias("name"), "text"), folder, ".txt")
    now = labels.select(F.col(key).cast("string").alias("stem")).distinct()
    remove_files(list_files(labels.sparkSession, folder, [".txt"]).join(now, "stem", "left_anti"))


def copy_plan(samples: DataFrame, key: str, source: str, folder: str) -> DataFrame:
    """``source, target``: each sample's file under its id, extension in lower case."""
    from curatrix.functions.text import suffix

    return samples.select(F.col(source).alias("source"), F.concat(F.lit(folder.rstrip("/") + "/"), F.col(key), suffix(F.col(source))).alias("target"))


def run_copies(plan: DataFrame) -> None:
    """Copy by the executors, through the file systems of source and target; a target appears only when it is whole, so a task may run twice."""

    def scan(batches):
        import pyarrow as pa

        for b in batches:
            for source, target in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                system, path, _ = store(source)
                with system.open_input_stream(path) as data:
                    put(target, data.read())
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    plan.select("source", "target").mapInArrow(scan, "n bigint").agg(F.sum("n")).collect()


def coco_tables(samples: DataFrame, boxes: DataFrame, key: str = "canonical_id") -> tuple[DataFrame, DataFrame]:
    """(images, annotations) with dense ids: images by sorted key, annotations by image and box index, both from 1.

    ``samples(key, file_name, width, height)`` and normalised ``boxes(key, box_index,
    x_center, y_center, width, height)``. Numbered by the distributed sort.
    """
    images = global_positions(samples.select(key, "file_name", "width", "height"), [key], "id").withColumn("id", F.col("id") + 1)
    size = images.select(key, F.col("id").alias("image_id"), F.col("width").alias("_w"), F.col("height").alias("_h"))
    px = centre_to_pixels(*(F.col(c) for c in ("x_center", "y_center", "width", "height")), F.col("_w"), F.col("_h"))
    rows = boxes.join(size, key).select("image_id", "box_index", F.array(*px).alias("bbox"), (px[2] * px[3]).alias("area"))
    rows = global_positions(rows, ["image_id", "box_index"], "id")
    rows = rows.select((F.col("id") + 1).alias("id"), "image_id", F.lit(1).alias("category_id"), "bbox", "area", F.lit(0).alias("iscrowd"), F.array().cast("array<array<double>>").alias("segmentation"))
    return images.select("id", "file_name", "width", "height"), rows


def coco_document(images: DataFrame, annotations: DataFrame, category: str = "license_plate", description: str = "") -> DataFrame:
    """One row ``document``: the whole COCO JSON. A document is one value, so this is for splits that fit one; ``coco_tables`` has no such bound."""
    pick = lambda df, name: df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name))
    one = pick(images, "images").crossJoin(pick(annotations, "annotations"))  # one row each
    body = F.struct(
        F.struct(F.lit(description).alias("description"), F.lit("1.0").alias("version")).alias("info"),
        F.array().cast("array<string>").alias("licenses"), "images", "annotations",
        F.array(F.struct(F.lit(1).alias("id"), F.lit(category).alias("name"), F.lit("none").alias("supercategory"))).alias("categories"),
    )
    return one.select(F.to_json(body).alias("document"))


def write_text_atomic(path: str, text: str) -> None:
    """Write beside the target, then replace it: readers see the old or the new file. On a local file system the data are synced first."""
    system, local, _ = store(path)
    if not isinstance(system, LocalFileSystem):
        put(path, text.encode())
        return
    part = f"{local}.tmp.{os.getpid()}"
    with open(part, "w", encoding="utf-8", newline="") as out:
        out.write(text)
        out.flush()
        os.fsync(out.fileno())
    os.replace(part, local)


def commit_texts(files: dict[str, str]) -> None:
    """All files or none: every text is written beside its target, old files are kept until all are in place, and put back on failure."""
    done: list[str] = []
    parts = {p: f"{p}.new" for p in files}
    try:
        for p, text in files.items():
            write_text_atomic(parts[p], text)
        for p in files:
            if exists(p):
                move(p, f"{p}.bak")
            done.append(p)
            move(parts[p], p)
    except OSError:
        for p in done:
            if exists(f"{p}.bak"):
                move(f"{p}.bak", p)
            else:
                remove(p)
        raise
    finally:
        for p in files:
            for q in (parts[p], f"{p}.bak"):
                remove(q)


def swap_folder(build: Callable[[str], None], target: str, check: Callable[[str], None] | None = None) -> None:
    """Build a folder beside the target, check it, swap it in, check again; the old folder comes back if that fails.

    For file systems that rename folders.
    """
    stage, old = f"{target}.stage", f"{target}.old"
    if exists(stage) or exists(old):
        raise ContractError(f"left over from an earlier run: {stage} or {old}")
    try:
        build(stage)
        if check:
            check(stage)
    except BaseException:
        remove(stage)
        raise
    if exists(target):
        move(target, old)
    try:
        move(stage, target)
        if check:
            check(target)
    except BaseException:
        remove(target)
        if exists(old):
            move(old, target)
        raise
    remove(old)


def backup(path: str, now: datetime | None = None) -> str | None:
    """Copy a file to a name with the time before it is edited; None if there is none."""
    if not exists(path):
        return None
    root, ext = os.path.splitext(path)
    name = f"{root}_{(now or datetime.now()):%Y%m%d_%H%M%S}{ext}"
    copy(path, name)
    return name


def with_constants(df: DataFrame, **values: object) -> DataFrame:
    """The table with constant columns, for a new version of a file."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def _versions(folder: str) -> list[int]:
    system, path, _ = store(folder)
    found = system.get_file_info(FileSelector(path, recursive=False, allow_not_found=True))
    whole = (x for x in found if re.fullmatch(r"version=\d+", x.base_name) and system.get_file_info(f"{x.path}/_SUCCESS").is_file)
    return sorted(int(x.base_name.split("=")[1]) for x in whole)


def write_version(df: DataFrame, folder: str) -> int:
    """Write the table as the next version of ``folder``; earlier versions stay, so ``df`` may read one. Returns its number."""
    number = max(_versions(folder), default=0) + 1
    df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/version={number}")
    return number


def read_version(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame:
    """A version of the table, the latest whole one if no number is given."""
    known = _versions(folder)
    if not known or (number is not None and number not in known):
        raise ContractError(f"{folder} has versions {known}")
    return spark.read.parquet(f"{folder.rstrip('/')}/version={number or known[-1]}")


def sheet_layout(df: DataFrame, order: list[str], columns: int, per_sheet: int) -> DataFrame:
    """Place of each row on contact sheets: ``sheet, row, column`` from 0, in the given order (drawing is left to others)."""
    rows = global_positions(df, order, "_at")
    spot = F.col("_at") % per_sheet
    return rows.withColumns({"sheet": F.floor(F.col("_at") / per_sheet), "row": F.floor(spot / columns), "column": spot % columns}).drop("_at")
