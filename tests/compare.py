"""Runs a query in Spark and its SQL twin in DuckDB, for a value-by-value check."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


_TYPES = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DATE": "date",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def _sort_key(row: tuple) -> tuple:
    return tuple((value is not None, str(value)) for value in row)


def spark_result(df):
    order = sorted(df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [tuple(row[c] for c in order) for row in df.collect()]
    return [(c, types[c]) for c in order], sorted(rows, key=_sort_key)


def duck_result(con, sql: str):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    rows = result.fetchall()
    positions = sorted(range(len(names)), key=names.__getitem__)
    schema = [
        (names[i], _TYPES.get(types[i], types[i].lower().replace(" ", "")))
        for i in positions
    ]
    return schema, sorted((tuple(row[i] for i in positions) for row in rows), key=_sort_key)
