"""Side-by-side comparison of a Spark result and a DuckDB result."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
    "DATE": "date",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _sorted_rows(rows: list[tuple], columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


def differences(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, types and rows agree."""
    rel = con.sql(sql)
    ours = dict(spark_df.dtypes)
    theirs = {c: TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types, strict=True)}
    problems = []
    if ours != theirs:
        extra = sorted(set(ours.items()) ^ set(theirs.items()))
        problems.append(f"schema differs: {extra}")
        if set(ours) != set(theirs):
            return problems
    left = _sorted_rows([tuple(r) for r in spark_df.collect()], spark_df.columns)
    right = _sorted_rows(rel.fetchall(), rel.columns)
    if len(left) != len(right):
        problems.append(f"{len(left)} rows, expected {len(right)}")
    bad = [(a, b) for a, b in zip(left, right, strict=False) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ ({sorted(ours)}), first: {bad[:2]}")
    return problems
