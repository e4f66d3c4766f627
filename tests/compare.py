"""Compare a Spark result with its SQL twin, ignoring row order."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, int):
        return value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    cells = [tuple(canonical(row[i]) for i in order) for row in rows]
    return names, sorted(cells, key=lambda r: tuple((c is None, str(c)) for c in r))


def spark_rows(frame):
    return sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    return sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
