"""Compares a Spark result with the oracle's, as rows of plain values in any order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return tuple(value) if isinstance(value, list) else value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both have the same columns, types of value and rows."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    found = rows_of(df.columns, df.collect())
    if found == expected and _types(found) == _types(expected):
        return None
    extra, missing = found - expected, expected - found
    return (
        f"rows {sum(found.values())} vs {sum(expected.values())}; "
        f"types {_types(found)} vs {_types(expected)}; columns {sorted(names)}; "
        f"only Spark: {list(extra)[:2]}; only oracle: {list(missing)[:2]}"
    )


def _types(rows: Counter) -> list[set[str]]:
    width = max((len(r) for r in rows), default=0)
    return [{type(r[i]).__name__ for r in rows if r[i] is not None} for i in range(width)]
