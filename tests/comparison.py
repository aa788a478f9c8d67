"""Compare a Spark result with DuckDB: columns by name, rows in any order, types by kind."""

from __future__ import annotations

import datetime
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, datetime.date):
        return "date"
    return type(value).__name__


def normalized(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple((_kind(row[i]), row[i]) for i in order) for row in rows]
    return sorted(cells, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), normalized([tuple(r) for r in df.collect()], df.columns)


def duckdb_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [entry[0] for entry in cursor.description]
    return sorted(columns), normalized(cursor.fetchall(), columns)


def type_kinds(df) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema}


# DuckDB type name → Spark type name.
SAME_TYPE = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def duckdb_types(con, sql: str) -> dict[str, str]:
    rows = con.execute(f"DESCRIBE {sql}").fetchall()
    return {row[0]: SAME_TYPE.get(row[1], row[1]) for row in rows}
