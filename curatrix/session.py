"""Session defaults, table access and the shared folder for tables that cut a lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []
_WRITTEN: list[str] = []


def local_session(cpus: int | str = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    parallel = "8" if cpus == "*" else str(cpus)
    settings = {
        "spark.sql.shuffle.partitions": parallel,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    return SparkSession.builder.master(f"local[{cpus}]").appName("curatrix").config(map=settings).getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


@atexit.register
def _drop_written() -> None:
    """Stage tables live as long as the driver's Python; their folders are removed when it ends."""
    for path in [*_WRITTEN, *_OWN]:
        if "://" not in path.replace("file://", ""):
            shutil.rmtree(path.removeprefix("file:").replace("///", "/", 1), ignore_errors=True)
        else:
            spark = SparkSession.getActiveSession()
            if spark is not None:
                _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    except Exception:  # noqa: BLE001 - a stage table that stays costs disk, not results
        pass


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only where that is unset on a local master (tests on one machine) a temporary folder
    is made, set in the session and removed when Python ends; on a cluster it raises, as
    no folder of one machine serves all executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        local = tempfile.mkdtemp(prefix="curatrix-")
        _OWN.append(local)
        folder = f"file://{os.path.abspath(local)}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the table read back.

    The written files survive the loss of an executor, cut the lineage, and later
    readers get column pruning. A reader never sees a half-written table, as the
    output committer moves files only when the job ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stage_tables(spark: SparkSession) -> Iterator[None]:
    """Stage tables and folders written inside are removed at the end, for a long session that is done with its results."""
    before = set(_WRITTEN)
    try:
        yield
    finally:
        for path in [p for p in _WRITTEN if p not in before]:
            _delete(spark, path)
            _WRITTEN.remove(path)


def forget_folder(path: str) -> str:
    """Have a folder removed when the driver's Python ends; returns it."""
    _WRITTEN.append(path)
    return path


def forget(df: DataFrame) -> None:
    """Delete the files behind a materialized table once nothing reads it any more."""
    files = df.inputFiles()
    for path in _WRITTEN:
        if files and os.path.basename(path) == os.path.basename(os.path.dirname(files[0])):
            _delete(df.sparkSession, path)
            _WRITTEN.remove(path)
            break
