"""Decision logs as streams: counts in event-time windows and a latest-wins table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curatrix.operators.review import latest_decisions


def read_log(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A stream over the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def window_counts(stream: DataFrame, at: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Decisions by kind in event-time windows; rows later than ``late`` behind the newest are dropped by the watermark."""
    return (
        stream.withWatermark(at, late)
        .groupBy(F.window(at, width).alias("w"), by)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select("w.start", "w.end", by, "row_count")
    )


def keep_latest(stream: DataFrame, path: str, checkpoint: str, key: str, status: str, at: str) -> StreamingQuery:
    """Maintain the latest decision of each key under ``path/version=N``, one version a micro-batch.

    Each batch is merged with the last complete version by the batch operator; a batch
    that runs again after a failure overwrites its own version only. Read with
    ``latest_version``. Processes what is there, then stops.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(key, status, at)
        if number > 0:
            rows = rows.unionByName(spark.read.parquet(f"{path}/version={number - 1}"))
        latest_decisions(rows, key, status, at).write.mode("overwrite").parquet(f"{path}/version={number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_version(spark: SparkSession, path: str) -> DataFrame:
    """The newest version that was written whole (it has the committer's marker)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(root)]
    whole = [n for n in names if n.startswith("version=") and system.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return spark.read.parquet(f"{path}/{max(whole, key=lambda n: int(n.split('=')[1]))}")
