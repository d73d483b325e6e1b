"""Runs registered queries in Spark and their SQL in DuckDB and compares schema and rows."""

from __future__ import annotations

import datetime as dt
import pathlib

import duckdb

SPARK_TO_DUCK = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf: str):
    connection = duckdb.connect()
    for path in pathlib.Path(sf).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _rows(names: list[str], rows) -> list[str]:
    order = sorted(range(len(names)), key=names.__getitem__)

    def plain(value):
        if isinstance(value, dt.datetime):
            return value.isoformat(sep=" ", timespec="microseconds")
        return value

    return sorted(repr([plain(row[i]) for i in order]) for row in rows)


def differences(df, connection, sql: str) -> list[str]:
    """What differs between ``df`` and the result of ``sql``; empty if nothing does."""
    found = connection.execute(sql)
    duck_types = {c[0]: str(c[1]) for c in found.description}
    duck_rows = found.fetchall()
    spark_types = {name: SPARK_TO_DUCK.get(kind, kind) for name, kind in df.dtypes}
    problems = []
    if duck_types != spark_types:
        problems.append(f"types differ: {sorted(set(spark_types.items()) ^ set(duck_types.items()))}")
        return problems
    ours = _rows(df.columns, [tuple(row) for row in df.collect()])
    theirs = _rows(list(duck_types), duck_rows)
    if len(ours) != len(theirs):
        problems.append(f"rows: spark {len(ours)}, duckdb {len(theirs)}")
    if ours != theirs:
        only_ours = [r for r, s in zip(ours, theirs) if r != s][:2]
        only_theirs = [s for r, s in zip(ours, theirs) if r != s][:2]
        problems.append(f"values: spark {only_ours} duckdb {only_theirs}")
    return problems
