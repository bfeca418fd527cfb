"""Compare a registered query with its SQL on DuckDB: names, types and all rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(sf)):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{file}'")
    return con


def compare(df, sql: str, con) -> str | None:
    """None if both sides agree, else what differs."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    ours = {name: SPARK_TO_DUCK.get(kind, kind) for name, kind in df.dtypes}
    if ours != theirs:
        return f"schema {ours} vs {theirs}"
    names = sorted(ours)
    spark_rows = Counter(tuple(r[n] for n in names) for r in df.collect())
    position = {d[0]: i for i, d in enumerate(result.description)}
    duck_rows = Counter(tuple(r[position[n]] for n in names) for r in result.fetchall())
    if spark_rows != duck_rows:
        extra, missing = list((spark_rows - duck_rows).items())[:3], list((duck_rows - spark_rows).items())[:3]
        return f"{sum(spark_rows.values())} vs {sum(duck_rows.values())} rows; only ours {extra}; only theirs {missing}"
    return None
