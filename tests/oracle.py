"""Comparison of a Spark result with a DuckDB result, row order and column order aside."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str, show: int = 3) -> str:
    """Empty when both results are the same bag of rows under the same names."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    expected = _bag(names, relation.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    actual = _bag(df.columns, [tuple(r) for r in df.collect()])
    if actual == expected:
        return ""
    missing, extra = expected - actual, actual - expected
    return (
        f"{sum(actual.values())} rows instead of {sum(expected.values())}; "
        f"missing {list(missing)[:show]}; extra {list(extra)[:show]}"
    )
