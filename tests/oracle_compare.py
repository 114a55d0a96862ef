"""Run a registered Spark query and its DuckDB oracle on the same parquet
tables and compare row count, column names, column kinds and values."""

from __future__ import annotations

import math

import duckdb

from fathom.sources.tables import TABLES

_SPARK_KIND = {
    "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int",
    "double": "float", "float": "float", "string": "str", "boolean": "bool",
    "timestamp_ntz": "ts", "timestamp": "ts", "date": "date",
}
_DUCK_KIND = {
    "BIGINT": "int", "INTEGER": "int", "SMALLINT": "int", "TINYINT": "int", "HUGEINT": "hugeint",
    "DOUBLE": "float", "FLOAT": "float", "VARCHAR": "str", "BOOLEAN": "bool",
    "TIMESTAMP": "ts", "DATE": "date", "UBIGINT": "int", "UINTEGER": "int",
}


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, repr(x)) for x in row)


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None, rel_tol: float = 1e-9):
    con = con or duck_connect(sf_dir)
    sdf = fn(spark, sf_dir)
    s_kinds = {f.name: _SPARK_KIND.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    rel = con.sql(sql)
    d_cols = rel.columns
    d_kinds = {c: _DUCK_KIND.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}")
        return False, problems
    if s_kinds != d_kinds:
        diff = {c: (s_kinds[c], d_kinds[c]) for c in s_kinds if s_kinds[c] != d_kinds.get(c)}
        problems.append(f"kinds differ: {diff}")
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_norm = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    d_norm = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    if len(s_norm) != len(d_norm):
        problems.append(f"row count spark={len(s_norm)} duck={len(d_norm)}")
    exact_bad = 0
    approx_bad = []
    for a, b in zip(s_norm, d_norm):
        if a != b:
            exact_bad += 1
            for c, x, y in zip(order, a, b):
                if x == y:
                    continue
                if isinstance(x, (int, float)) and isinstance(y, (int, float)) and x is not True \
                        and math.isclose(x, y, rel_tol=rel_tol, abs_tol=1e-9):
                    continue
                approx_bad.append((c, x, y))
    if exact_bad:
        problems.append(f"{exact_bad} rows differ exactly; approx diffs: {approx_bad[:6]}")
    return not problems, problems
