"""Compare a query with its SQL twin: names, row count, and values without regard to order."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path


def _plain(v):
    if v is None or isinstance(v, bool | str):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, int):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else int(v) if v.is_integer() and abs(v) < 1e15 else float(f"{v:.9g}")
    if isinstance(v, datetime.datetime | datetime.date):
        return str(v)
    if isinstance(v, list | tuple):
        return tuple(map(_plain, v))
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    return str(v)


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def differences(spark, folder: str, query, sql: str, con=None) -> str:
    """Empty if both sides agree."""
    con = con or connect(folder)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    df = query(spark, folder)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    got = rows_of(df.columns, df.collect())
    if got == want:
        return ""
    return f"{sum(got.values())} rows against {sum(want.values())}; only Spark: {list((got - want).items())[:3]}; only SQL: {list((want - got).items())[:3]}"
