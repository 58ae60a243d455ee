"""Compare a Spark result with its SQL oracle run by DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
from pathlib import Path

import duckdb

TEST_DATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def normalised(columns: list[str], rows) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([_plain(row[i]) for i in order]) for row in rows)


def spark_result(df) -> tuple[list[str], list[str]]:
    return normalised(df.columns, [tuple(row) for row in df.collect()])


def oracle_result(con, sql: str) -> tuple[list[str], list[str]]:
    cursor = con.execute(sql)
    return normalised([d[0] for d in cursor.description], cursor.fetchall())


_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def type_differences(con, df, sql: str) -> list[str]:
    wanted = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        f"{name}: {kind} / {wanted.get(name)}"
        for name, kind in df.dtypes
        if _TYPES.get(kind, kind) != wanted.get(name)
    ]
