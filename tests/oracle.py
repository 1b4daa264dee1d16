"""Side-by-side check of a registered query against its DuckDB oracle:
row count, column names and an order-insensitive comparison of values
(doubles rounded to 6 places)."""

from __future__ import annotations

import math
import re
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, int(v))
    if isinstance(v, (int,)):
        return (2, float(v))
    if isinstance(v, (float, Decimal)):
        f = float(v)
        if math.isnan(f):
            return (3, "nan")
        return (2, round(f, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return (4, tuple(_norm(x) for x in v))
    return (5, str(v))


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return cols, out


def _kind(type_name: str) -> str:
    """Integer, number, text, truth value or list, of a Spark or DuckDB type."""
    t = type_name.lower()
    if t.endswith("[]") or t.startswith("array"):
        return "list"
    if "int" in t:
        return "integer"
    if t.startswith(("double", "float", "decimal", "real")):
        return "number"
    if t.startswith("bool"):
        return "truth value"
    return "text" if t in ("string", "varchar") else t


def compare(spark, con, name, query, sql, sf_dir, folder=None):
    """Problems and row count. With ``folder`` the result is written there as
    Parquet and read back first. Types are compared by kind, and where the SQL
    ends in an ORDER BY, rows in their order."""
    sdf = query(spark, sf_dir)
    ordered = re.search(r"ORDER BY[^()]*$", sql) is not None
    if folder:
        (sdf.coalesce(1) if ordered else sdf).write.parquet(f"{folder}/{name}")
        sdf = spark.read.parquet(f"{folder}/{name}")
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_types = {d[0]: _kind(str(d[1])) for d in res.description}
    d_rows = res.fetchall()
    sc, sr = normalise(s_cols, s_rows)
    dc, dr = normalise(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns {sc} vs {dc}")
    else:
        wrong = {c: (t, d_types[c]) for c, t in sdf.dtypes if _kind(t) != d_types[c] and {_kind(t), d_types[c]} != {"integer", "number"}}
        if wrong:
            problems.append(f"types {wrong}")
    if len(sr) != len(dr):
        problems.append(f"rows {len(sr)} vs {len(dr)}")
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr, strict=True) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    elif ordered and sc == dc:
        at_s, at_d = [s_cols.index(c) for c in sc], [d_cols.index(c) for c in sc]
        if [[_norm(r[i]) for i in at_s] for r in s_rows] != [[_norm(r[i]) for i in at_d] for r in d_rows]:
            problems.append("order differs")
    return problems, len(sr)
