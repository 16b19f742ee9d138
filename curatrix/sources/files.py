"""Listings, digests and images of folders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.contracts import ContractError, require_unique
from curatrix.functions.text import is_hex_id, stem, suffix
from curatrix.sources.storage import tree

IMAGE_SUFFIXES = [".bmp", ".jpeg", ".jpg", ".png", ".webp"]


def list_files(spark: SparkSession, folder: str, suffixes: list[str] | None = None, recursive: bool = False, content: bool = False) -> DataFrame:
    """``path, stem, suffix, length, modificationTime`` (and ``content``) of the files of a folder.

    Listed by the executors (``storage.tree``), files of no bytes included. Without
    ``content`` the bytes are not read. Suffixes are compared in lower case. A folder
    without files gives an empty table.
    """
    files = tree(spark, folder, recursive)
    files = files.select("path", stem(F.col("path")).alias("stem"), suffix(F.col("path")).alias("suffix"), "length", "modificationTime")
    files = files.where(F.col("suffix").isin(suffixes)) if suffixes else files
    if not content:
        return files
    empty = files.where("length = 0").withColumn("content", F.lit(b""))
    if files.where("length > 0").isEmpty():
        return empty
    # a scan passes over files of no bytes only, so nothing has to be joined
    full = _scan(spark, "binaryFile", suffixes, recursive).load(folder)
    full = full.select("path", stem(F.col("path")).alias("stem"), suffix(F.col("path")).alias("suffix"), "length", "modificationTime", "content")
    full = full.where(F.col("suffix").isin(suffixes)) if suffixes else full
    return full.where("length > 0").unionByName(empty)


def _same(path):
    """One spelling of a local path, however many slashes its scheme has."""
    return F.regexp_replace(path, "^file:/+", "/")


def _scan(spark: SparkSession, form: str, suffixes: list[str] | None, recursive: bool):
    reader = spark.read.format(form)
    if suffixes:
        either = lambda s: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in s)
        reader = reader.option("pathGlobFilter", f"*{{{','.join(map(either, suffixes))}}}")
    return reader.option("recursiveFileLookup", "true") if recursive else reader


def by_stem(files: DataFrame) -> DataFrame:
    """``stem, path`` of a listing; two files of one stem raise."""
    return require_unique(files.select("stem", "path"), ["stem"], "listing")


def digests(spark: SparkSession, folder: str, suffixes: list[str] | None = None, recursive: bool = False, upper: bool = False) -> DataFrame:
    """``path, stem, sha256`` of the files' bytes."""
    files = list_files(spark, folder, suffixes, recursive, content=True)
    value = F.sha2("content", 256)
    return files.select("path", "stem", (F.upper(value) if upper else value).alias("sha256"))


def images(spark: SparkSession, folder: str, recursive: bool = False, suffixes: list[str] = IMAGE_SUFFIXES) -> DataFrame:
    """``path, width, height, channels, mode, data, corrupt``: decoded images, bytes in the order blue, green, red.

    Only files with an image's suffix count. A file that can't be decoded, or has no
    bytes, has ``corrupt`` true and no data.
    """
    listed = list_files(spark, folder, suffixes, recursive)
    empty = listed.where("length = 0").select("path")
    cols = "path string, width int, height int, channels int, mode int, data binary, corrupt boolean"
    none = empty.select("path", *(F.lit(None).cast(t).alias(n) for n, t in (c.split() for c in cols.split(", ")[1:-1])), F.lit(True).alias("corrupt"))
    if listed.where("length > 0").isEmpty():
        return none
    rows = _scan(spark, "image", suffixes, recursive).option("dropInvalid", "false").load(folder).select("image.*")
    bad = (F.col("height") < 1) | F.col("height").isNull()
    number = lambda c: F.when(~bad, F.col(c)).alias(c)
    rows = rows.select(F.concat(F.lit("file:"), _same(F.col("origin"))).alias("path") if "://" not in folder else F.col("origin").alias("path"), number("width"), number("height"), number("nChannels").alias("channels"), number("mode"), F.when(~bad, F.col("data")).alias("data"), bad.alias("corrupt"))
    return rows.unionByName(none)


def resolve(names: DataFrame, files: DataFrame, folders: list[str], suffixes: list[str], key: str = "stem") -> DataFrame:
    """For each stem the first file that exists, folders before suffixes: ``key, path``; null where none does."""
    order = [(i * len(suffixes) + j, d.rstrip("/"), s) for i, d in enumerate(folders) for j, s in enumerate(suffixes)]
    spots = F.explode(F.array(*(F.struct(F.lit(n).alias("n"), F.lit(d).alias("d"), F.lit(s).alias("s")) for n, d, s in order)))
    want = names.select(key, spots.alias("o")).select(key, "o.n", F.concat("o.d", F.lit("/"), key, "o.s").alias("path"))
    have = files.select(F.regexp_replace("path", r"^file:/+", "/").alias("path")).distinct()
    best = want.join(have, "path").groupBy(key).agg(F.min_by("path", "n").alias("path"))
    return names.select(key).distinct().join(best, key, "left")


def unique_root(files: DataFrame, marker: str) -> str:
    """The only folder that holds a file or folder of this name; none or several raise."""
    at = F.regexp_extract("path", rf"^(.*)/{marker}(/|$)", 1).alias("root")
    found = [r[0] for r in files.select(at).where("root <> ''").distinct().limit(3).collect()]
    if len(found) != 1:
        raise ContractError(f"{marker}: found in {found or 'no folder'}")
    return found[0]


def inventory(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(listed files whose stem is an id of 16 hex digits, with ``image_id`` in lower case; all others)."""
    good = is_hex_id(F.col("stem"))
    return files.where(good).withColumn("image_id", F.lower("stem")), files.where(~good)


def _area_resize(grey: np.ndarray, rows: int, cols: int) -> np.ndarray:
    """Mean of the area that each target pixel covers, with fractional edges."""

    def weights(n: int, m: int) -> np.ndarray:
        edges = np.arange(m + 1) * n / m
        lo, hi = edges[:-1, None], edges[1:, None]
        cells = np.arange(n)
        return np.clip(np.minimum(hi, cells + 1) - np.maximum(lo, cells), 0, None) * m / n

    return weights(grey.shape[0], rows) @ grey @ weights(grey.shape[1], cols).T


def _cosine(n: int) -> np.ndarray:
    k = np.arange(n)
    base = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * n)) * np.sqrt(2 / n)
    base[0] /= np.sqrt(2)
    return base


_DCT = _cosine(32)


def _bits(flags: np.ndarray) -> int:
    value = int("".join("1" if f else "0" for f in flags.ravel()), 2)
    return value - (1 << 64) if value >> 63 else value


def fingerprint(bgr: np.ndarray) -> tuple[int, int]:
    """(phash, dhash) of an image as signed 64-bit integers, most significant bit first, row by row.

    phash: grey, 32 x 32 by area, cosine transform, the lowest 8 x 8 coefficients above
    the median of those but the first. dhash: grey, 8 rows of 9 by area, each pixel
    against its right neighbour. Grey is rounded to whole numbers.
    """
    grey = np.round(bgr[..., :3].astype(float) @ np.array([0.114, 0.587, 0.299])) if bgr.shape[2] >= 3 else bgr[..., 0].astype(float)
    low = (_DCT @ np.round(_area_resize(grey, 32, 32)) @ _DCT.T)[:8, :8]
    small = np.round(_area_resize(grey, 8, 9))
    return _bits(low > np.median(low.ravel()[1:])), _bits(small[:, 1:] > small[:, :-1])


_PRINT_COLUMNS = "path string, width int, height int, aspect_ratio double, pixel_sha256 string, phash bigint, dhash bigint, pixel_min int, pixel_max int, pixel_mean double, pixel_std double"


def fingerprints(decoded: DataFrame) -> DataFrame:
    """Fingerprints and pixel statistics of decoded images; corrupt ones are left out.

    ``pixel_sha256`` is over width and height (32-bit, low byte first) and the bytes in
    the order red, green, blue. Statistics are over all channels; the deviation is of
    the population. Pixels have no built-in expression, so Arrow batches are used.
    """
    import hashlib

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for path, w, h, c, data in zip(*(col.to_pylist() for col in b.columns)):
                pixels = np.frombuffer(data, np.uint8).reshape(h, w, c)
                rgb = pixels[..., 2::-1] if c >= 3 else np.repeat(pixels[..., :1], 3, axis=2)
                digest = hashlib.sha256(w.to_bytes(4, "little") + h.to_bytes(4, "little") + rgb.tobytes()).hexdigest()
                p, d = fingerprint(pixels)
                rows.append((path, w, h, w / h, digest, p, d, int(rgb.min()), int(rgb.max()), float(rgb.mean()), float(rgb.std())))
            if rows:
                types = [pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
                names = [x.split()[0] for x in _PRINT_COLUMNS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names)

    return decoded.where("not corrupt").select("path", "width", "height", "channels", "data").mapInArrow(scan, _PRINT_COLUMNS)


def pixel_flags(prints: DataFrame) -> DataFrame:
    """Add ``all_black`` (maximum 0), ``near_black`` (at most 2) and ``near_uniform`` (deviation at most 1)."""
    return prints.withColumns({"all_black": F.col("pixel_max") == 0, "near_black": F.col("pixel_max") <= 2, "near_uniform": F.col("pixel_std") <= 1.0})
