"""Compare a Spark result with a DuckDB result value by value."""

from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if v is None:
        return ("", "null")
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, datetime):
        return ("time", v.isoformat())
    if isinstance(v, date):
        return ("date", v.isoformat())
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        return ("float", repr(v + 0.0))
    if isinstance(v, int):
        return ("int", v)
    return (type(v).__name__, v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


# Spark type names of DuckDB's.
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "boolean": "BOOLEAN"}


def type_difference(df, con, sql):
    ours = {f.name: SAME_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    wrong = {c: (ours.get(c), theirs.get(c)) for c in {*ours, *theirs} if ours.get(c) != theirs.get(c)}
    return wrong or None


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(con, sql):
    cur = con.execute(sql)
    return canonical([d[0] for d in cur.description], cur.fetchall())


def difference(left, right):
    """None when equal, else a short text."""
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows != {len(right[1])} rows"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return f"{len(wrong)} rows differ, e.g. {wrong[0]}" if wrong else None
