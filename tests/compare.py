"""Runs a query on Spark and its SQL on DuckDB and compares all rows."""

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if v == 0 and isinstance(v, float):
        return 0.0
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def differences(df, con, sql):
    """Empty when equal; else what differs."""
    got = df.collect()
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    want = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wrong = {n: (t, types[n]) for n, t in df.dtypes if SAME.get(t) != types[n]}
    if wrong:
        return f"types {wrong}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        return (
            f"rows {sum(a.values())} / {sum(b.values())}; only here {list((a - b).items())[:3]}; "
            f"only SQL {list((b - a).items())[:3]}; of {sum((a - b).values())}"
        )
    return ""
