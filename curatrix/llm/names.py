"""Spellings that mean the same: ids, datasets, groups, splits and statuses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curatrix.functions.hashing import let

# Extensions of image files, and words that stand for a missing group.
IMAGE_EXTENSIONS = ["avif", "bmp", "gif", "heic", "jpeg", "jpg", "png", "tif", "tiff", "webp"]
PLACEHOLDERS = ["", "-", "--", "n/a", "na", "nan", "none", "null", "unknown", "–", "—"]
SPLIT_SPELLINGS = {"train": ["train", "training"], "val": ["val", "valid", "validation"], "test": ["test", "testing"]}

_EDGES = r"^[\s ]+|[\s ]+$"


def trimmed(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, _EDGES, "")


def id_key(identifier: Column) -> Column:
    """An id without letter case, surrounding blanks and an image extension; null if nothing is left."""
    bare = F.regexp_replace(F.lower(trimmed(identifier)), rf"\.({'|'.join(IMAGE_EXTENSIONS)})$", "")
    return F.nullif(bare, F.lit(""))


def word_key(text: Column) -> Column:
    """Only the letters and digits of a name, in lower case; null if there are none."""
    return F.nullif(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", ""), F.lit(""))


def group_key(dataset: Column, group: Column) -> Column:
    """``dataset|group`` of one source, null where the dataset or the group is missing or a placeholder.

    Letter case, surrounding blanks, the separators within the dataset's name, leading
    folders, a frame mark ``#t=...`` and an export suffix ``.rf.`` + hash + extension
    make no difference.
    """

    def named(whole: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(whole, r"^.*[/\\]", ""), r"#t=.*$", ""), r"\.rf\.[0-9a-z]+\.[a-z0-9]+$", "")
        return let(trimmed(bare), lambda b: F.when(~(whole.isin(PLACEHOLDERS) | b.isin(PLACEHOLDERS)), b))

    return F.concat(word_key(dataset), F.lit("|"), let(F.lower(trimmed(group)), named))


def split_key(split: Column) -> Column:
    """train, val or test; null for any other text."""
    names = F.create_map(*(F.lit(x) for name, spellings in SPLIT_SPELLINGS.items() for s in spellings for x in (s, name)))
    return F.try_element_at(names, F.lower(trimmed(split)))


def is_included(status: Column) -> Column:
    return F.coalesce(F.lower(trimmed(status)) == "included", F.lit(False))
