"""Compare a Spark result with the rows its SQL gives."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def _form(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_form(r[i]) for i in order) for r in data)


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def difference(df, sql: str, sf_dir: str) -> str:
    """Empty when both agree, else a short account of what differs."""
    names, expected = oracle_rows(sql, sf_dir)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    got, want = rows(df.columns, df.collect()), rows(names, expected)
    extra, missing = got - want, want - got
    if not extra and not missing:
        return ""
    return (f"{sum(got.values())} vs {sum(want.values())} rows; {sum(extra.values())} extra "
            f"{list(extra)[:2]}; {sum(missing.values())} missing {list(missing)[:2]}")
