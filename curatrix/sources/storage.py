"""Files by path or URI, on the driver and on executors, through Arrow's file systems (local, hdfs, s3, gs, abfs)."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTED = "path string, length bigint, modificationTime timestamp, folder boolean"


def store(uri: str) -> tuple[fs.FileSystem, str, str]:
    """(file system, path in it, what stands before the path in a URI)."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), os.path.abspath(uri), "file:"
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/"), "file:"
    scheme, rest = uri.split("://", 1)
    system, path = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")
    before = uri[: len(uri) - len(path.rstrip("/"))] if uri.rstrip("/").endswith(path.rstrip("/")) else f"{scheme}://"
    return system, path, before


def _children(folders: list[str]) -> Iterator[tuple]:
    for folder in folders:
        system, path, before = store(folder)
        for info in system.get_file_info(fs.FileSelector(path, recursive=False, allow_not_found=True)):
            if not info.base_name.startswith((".", "_")):
                yield before + info.path, info.size or 0, info.mtime, info.type == fs.FileType.Directory


def tree(spark: SparkSession, folder: str, recursive: bool) -> DataFrame:
    """``path, length, modificationTime`` of the files of a folder, those of no bytes included.

    Folders are listed by the executors, one level of the tree a job, so the driver
    never holds the paths. Hidden names (``.`` or ``_`` first) are passed over, as
    Spark's own scans do. A folder that isn't there has no files.
    """
    from curatrix.session import materialize

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(_children(b.column(0).to_pylist()))
            for k in range(0, len(rows), 50_000):
                paths, sizes, times, kinds = zip(*rows[k : k + 50_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(paths), pa.array(sizes, pa.int64()), pa.array(times, pa.timestamp("us", tz="UTC")), pa.array(kinds)], ["path", "length", "modificationTime", "folder"]
                )

    level, out = spark.createDataFrame([(folder,)], "path string"), None
    while True:
        found = materialize(level.mapInArrow(scan, LISTED), "listing")
        files = found.where("not folder").drop("folder")
        out = files if out is None else out.unionByName(files)
        level = found.where("folder").select("path")
        if not recursive or level.isEmpty():
            return out
        level = level.repartition(spark.sparkContext.defaultParallelism)


def put(uri: str, data: bytes) -> None:
    """Write beside the target, then move it in place: a reader sees the old or the new file, and a task may run twice."""
    import uuid

    system, path, _ = store(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    part = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.{uuid.uuid4().hex}")
    with system.open_output_stream(part) as out:
        out.write(data)
    system.move(part, path)


def put_files(rows: DataFrame, folder: str) -> None:
    """One file for each row of ``name, data`` (binary), written by the executors below ``folder``."""
    base = folder.rstrip("/")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                put(f"{base}/{name}", data or b"")
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    rows.select("name", "data").mapInArrow(scan, "n bigint").agg(F.sum("n")).collect()


def remove_files(paths: DataFrame) -> None:
    """Delete the files of column ``path`` by the executors; one that is gone is no error."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                system, path, _ = store(uri)
                if system.get_file_info(path).type != fs.FileType.NotFound:
                    system.delete_file(path)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    paths.select("path").mapInArrow(scan, "n bigint").agg(F.sum("n")).collect()


def exists(uri: str) -> bool:
    system, path, _ = store(uri)
    return system.get_file_info(path).type != fs.FileType.NotFound


def move(source: str, target: str) -> None:
    """Rename a file or folder within one file system; a file in the way is replaced."""
    system, path, _ = store(source)
    system.move(path, store(target)[1])


def copy(source: str, target: str) -> None:
    system, path, _ = store(source)
    system.copy_file(path, store(target)[1])


def remove(uri: str) -> None:
    """Delete a file or a folder with all that is in it; nothing happens if it isn't there."""
    system, path, _ = store(uri)
    kind = system.get_file_info(path).type
    if kind == fs.FileType.Directory:
        system.delete_dir(path)
    elif kind != fs.FileType.NotFound:
        system.delete_file(path)
