"""The library's queries over the test tables, by subject, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from curatrix.plans import audits, boxes, checks, detections, duplicates, files, joins, selections, texts

MODULES = [duplicates, audits, joins, texts, selections, boxes, detections, files, checks]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for m in MODULES for name, fn in m.BOOK.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.BOOK.oracles.items()}
