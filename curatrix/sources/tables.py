"""CSV and JSON inputs, with pinned types and tolerated absences."""

from __future__ import annotations

import time
import urllib.request

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from curatrix.contracts import ContractError, require_columns, require_complete, require_unique
from curatrix.functions.text import folded
from curatrix.sources.storage import remove, store


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def _pinned(field, pin: StructField, tolerant: bool):
    """The field as the pinned type; what doesn't fit raises unless tolerated."""
    value = field.try_cast(pin.dataType)
    if tolerant:
        return value
    problem = F.raise_error(F.concat(F.lit(f"{pin.name} is not {pin.dataType.simpleString()}: "), field)).cast(pin.dataType)
    return F.when(field.isNotNull() & value.isNull(), problem).otherwise(value)


def read_csv(spark: SparkSession, path: str, schema: str | StructType | None = None, header: bool = True, columns: list[str] | None = None, missing_ok: bool = False, multi_line: bool = False, tolerant: bool = False) -> DataFrame:
    """A CSV with doubled quotes; a byte order mark is dropped.

    Without a schema every column is text, so ids of digits stay as they are. With one,
    columns are found by name in a file with a header, in any order; a field that doesn't
    fit its pinned type raises, or is null if ``tolerant``. ``columns`` prunes the scan.
    Blank fields are null. ``missing_ok`` gives an empty table of the schema where the
    file is absent or empty. ``multi_line`` allows line breaks inside quotes, for which a
    file must be read in one task; without it large files are split.
    """
    if missing_ok and schema is None:
        raise ValueError("missing_ok needs a schema")
    wanted = schema if isinstance(schema, StructType) or schema is None else StructType.fromDDL(schema)
    if missing_ok and not _exists(spark, path):
        return spark.createDataFrame([], wanted)
    text = spark.read.option("header", header).option("multiLine", multi_line).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
    if wanted is None:
        rows = text.csv(path)
    elif header:
        rows = text.csv(path)
        if not rows.columns and missing_ok:
            return spark.createDataFrame([], wanted)
        require_columns(rows, wanted.names)
        rows = rows.select(*(_pinned(F.col(f"`{f.name}`"), f, tolerant).alias(f.name) for f in wanted))
    else:
        plain = StructType([StructField(f.name, StringType()) for f in wanted])
        rows = text.schema(plain).csv(path).select(*(_pinned(F.col(f"`{f.name}`"), f, tolerant).alias(f.name) for f in wanted))
    return rows.select(*columns) if columns else rows


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Documents of one object each."""
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def read_provenance(spark: SparkSession, path: str, key: str, columns: list[str]) -> DataFrame:
    """A provenance table: required columns, key trimmed and lower case, unique and not blank."""
    rows = require_columns(read_csv(spark, path), [key, *columns]).select(F.nullif(folded(F.col(key)), F.lit("")).alias(key), *columns)
    return require_unique(require_complete(rows, [key]), [key], "provenance")


def wanted_rows(table: DataFrame, keys: DataFrame, on: str, most: int = 1_000_000) -> DataFrame:
    """Rows of a large table whose key is wanted, in one scan; the keys are broadcast up to ``most`` (checked), else shuffled."""
    unique = keys.select(on).distinct()
    return table.join(F.broadcast(unique) if unique.count() <= most else unique, on, "left_semi")


def read_review(spark: SparkSession, path: str, key: str, status: str = "review_status") -> DataFrame:
    """Earlier decisions (``key, status``); an absent file is no decision."""
    return read_csv(spark, path, f"`{key}` string, `{status}` string", missing_ok=True)


def download(url: str, path: str, tries: int = 4, timeout: float = 60.0, opener=urllib.request.urlopen, wait=time.sleep) -> str:
    """Fetch a file unless it is there; failures are tried again after 1, 2, 4 ... seconds, and no partial file stays.

    A driver-side helper for a handful of index files, not for rows of a table.
    """
    system, place, _ = store(path)
    if system.get_file_info(place).size:
        return path
    last: Exception | None = None
    for k in range(tries):
        try:
            with opener(url, timeout=timeout) as response, system.open_output_stream(f"{place}.part") as out:
                while chunk := response.read(1 << 20):
                    out.write(chunk)
            system.move(f"{place}.part", place)
            return path
        except OSError as e:
            last = e
            remove(f"{path}.part")
            if k + 1 < tries:
                wait(2**k)
    raise ContractError(f"{url}: {last}")


def fetch_rows(rows: DataFrame, key: str, url: str, fetch, tries: int = 1, pause: float = 1.0) -> DataFrame:
    """``key, bytes, error`` of ``fetch(url) -> bytes`` for each row, on the executors; failures are collected, not raised.

    A failed row is tried again up to ``tries`` times in all, after 1, 2, 4 ... times ``pause`` seconds.
    """
    import pyarrow as pa

    def scan(batches):
        for b in batches:
            got = []
            for k, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for attempt in range(tries):
                    try:
                        row = (k, fetch(u), None)
                        break
                    except Exception as e:  # noqa: BLE001
                        row = (k, None, f"{type(e).__name__}: {e}")
                        if attempt + 1 < tries:
                            time.sleep(pause * 2**attempt)
                got.append(row)
            if got:
                k, data, err = zip(*got)
                yield pa.RecordBatch.from_arrays([pa.array(k, b.schema.field(0).type), pa.array(data, pa.binary()), pa.array(err, pa.string())], ["key", "bytes", "error"])

    kind = dict(rows.dtypes)[key]
    return rows.select(key, url).mapInArrow(scan, f"key {kind}, bytes binary, error string").withColumnRenamed("key", key)
