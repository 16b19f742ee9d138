"""Text expressions over names, ids, flags and lists (each takes and gives a Column)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings of booleans, and the names a plate class goes by.
TRUE_WORDS, FALSE_WORDS = ["1", "true", "yes"], ["0", "false", "no"]
PLATE_NAMES = ["licence plate", "licence_plate", "license plate", "license_plate", "number plate", "number_plate", "plate"]


def strip_export_suffix(name: Column) -> Column:
    """The source key of an exported file: without ``.rf.`` + 32 hex digits + extension."""
    return F.regexp_replace(name, r"(?i)\.rf\.[0-9a-f]{32}\.[a-z0-9]+$", "")


def stem(path: Column) -> Column:
    """File name without folders and without its last extension."""
    return F.regexp_replace(F.regexp_replace(path, r"^.*[/\\]", ""), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """Last extension in lower case with its dot; empty if there is none."""
    return F.lower(F.regexp_extract(path, r"[^/\\](\.[^./\\]*)$", 1))


def inside(path: Column, root: Column) -> Column:
    """Whether ``path`` lies under the folder ``root`` after empty and ``.`` steps are dropped; a ``..`` step counts as outside."""
    plain = F.regexp_replace(F.regexp_replace(path, r"/(\./)*/*", "/"), r"^\./", "")
    base = F.regexp_replace(root, r"/+$", "")
    return ~path.rlike(r"(^|/)\.\.(/|$)") & F.startswith(plain, F.concat(base, F.lit("/")))


def sequence_name(name: Column) -> Column:
    """Text before the first ``#t=``, else the stem."""
    return F.when(F.contains(name, F.lit("#t=")), F.substring_index(name, "#t=", 1)).otherwise(stem(name))


def sequence_frame(name: Column, strict: bool = True) -> Column:
    """Struct (sequence, frame) of ``<sequence>#t=<frame>.<ext>``; another form raises, or gives null if not strict."""
    pattern = r"^(.+)#t=(\d+)\.[A-Za-z0-9]+$"
    parts = F.struct(F.regexp_extract(name, pattern, 1).alias("sequence"), F.try_to_number(F.regexp_extract(name, pattern, 2), F.lit("9999999999")).cast("int").alias("frame"))
    other = F.raise_error(F.concat(F.lit("not a frame of a sequence: "), F.coalesce(name, F.lit("null")))) if strict else F.lit(None)
    return F.when(name.rlike(pattern), parts).otherwise(other)


def is_hex_id(text: Column) -> Column:
    """Exactly 16 hex digits."""
    return F.coalesce(text.rlike("^[0-9a-fA-F]{16}$"), F.lit(False))


def folded(text: Column) -> Column:
    return F.lower(F.trim(text))


def alias_headers(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Rename columns whose name matches an alias, case and surrounding blanks aside; two columns for one name raise."""
    plain = lambda c: c.strip().lower()
    wanted = {plain(a): name for name, others in aliases.items() for a in (name, *others)}
    new = {c: wanted[plain(c)] for c in df.columns if plain(c) in wanted}
    if len(set(new.values())) < len(new):
        raise ValueError(f"several columns for one name: {new}")
    return df.withColumnsRenamed(new)


def to_bool(text: Column, strict: bool = True) -> Column:
    """Three spellings of true and three of false, blanks and case aside; any other text raises, or is null if not strict."""
    word = folded(text)
    other = F.raise_error(F.concat(F.lit("not a boolean: "), F.coalesce(text, F.lit("null")))) if strict else F.lit(None)
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False)).otherwise(other.cast("boolean"))


def is_plate_class(name: Column) -> Column:
    """Whether a class name, case aside and ``-`` taken for ``_``, is one of the names of a plate."""
    return F.coalesce(F.translate(folded(name), "-", "_").isin(PLATE_NAMES), F.lit(False))


def move_prefix(path: Column, old: str, new: str) -> Column:
    """``path`` with the prefix ``old`` replaced; any other path as it is."""
    return F.when(F.startswith(path, F.lit(old)), F.concat(F.lit(new), F.substring(path, F.lit(len(old) + 1), F.length(path)))).otherwise(path)


def sorted_concat(values: Column, separator: str = ";") -> Column:
    """Aggregate: distinct non-null values, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(values)), separator)


def list_items(text: Column, separator: str = ";") -> Column:
    """Array of the trimmed, non-blank items of a list in one string; null for null."""
    return F.filter(F.transform(F.split(text, re.escape(separator)), lambda x: F.trim(x)), lambda x: x != "")


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text.cast("string")) == "")


def fill_blank(text: Column, word: str = "<MISSING>") -> Column:
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(word))


def composite(*parts: Column, separator: str = "::") -> Column:
    """Key of several parts; null if any part is."""
    return F.when(~F.greatest(*(p.isNull() for p in parts)) if len(parts) > 1 else parts[0].isNotNull(), F.concat_ws(separator, *parts))


def first_status(*rules: tuple[Column, str], default: str = "accepted") -> Column:
    """Status of the first rule that holds; a null condition does not hold."""
    out = F.lit(default)
    for when, name in reversed(rules):
        out = F.when(when, F.lit(name)).otherwise(out)
    return out


def ocr_plain(text: Column) -> Column:
    """Only ASCII letters and digits, in upper case."""
    return F.upper(F.regexp_replace(text, "[^A-Za-z0-9]+", ""))
