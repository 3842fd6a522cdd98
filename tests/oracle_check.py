"""Compare registered queries with their SQL twins: names, types, row counts and every value."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import SparkSession

SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def differences(spark: SparkSession, con, query, sql: str, sf_dir: str) -> list[str]:
    """What differs between a query and its twin; empty when they agree."""
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    problems = []
    if sorted(types) != columns:
        return [f"columns {columns} != {sorted(types)}"]
    for name, kind in df.dtypes:
        if SAME_TYPE.get(kind) != _duck_type(con, sql, name):
            problems.append(f"type of {name}: {kind} != {_duck_type(con, sql, name)}")
    ours = _sorted([tuple(r) for r in df.select(*columns).collect()])
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = _sorted(con.execute(f"SELECT {quoted} FROM ({sql})").fetchall())
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    elif ours != theirs:
        first = next((a, b) for a, b in zip(ours, theirs, strict=True) if a != b)
        problems.append(f"first difference {first}")
    return problems


_types: dict[str, dict[str, str]] = {}


def _duck_type(con, sql: str, name: str) -> str:
    if sql not in _types:
        _types[sql] = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return _types[sql][name]
