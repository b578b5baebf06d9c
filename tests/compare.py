"""Compare Spark results with DuckDB results as multisets of rows, types included."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, Decimal):
        return f"{float(value):.9g}"
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types and rows agree."""
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    types = {c[0]: str(c[1]) for c in rel.description}
    expected = _rows(names, rel.fetchall())
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns: spark {sorted(df.columns)} duckdb {sorted(names)}"]
    for name, kind in df.dtypes:
        if _TYPES.get(kind) != types[name]:
            found.append(f"type of {name}: spark {kind} duckdb {types[name]}")
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if actual != expected:
        found.append(f"rows: spark {sum(actual.values())} duckdb {sum(expected.values())}")
        found += [f"  only spark  {r} x{n}" for r, n in list((actual - expected).items())[:3]]
        found += [f"  only duckdb {r} x{n}" for r, n in list((expected - actual).items())[:3]]
    return found
