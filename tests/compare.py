"""Runs a query and its SQL twin and compares the rows, whatever their order."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None when both give the same rows, else what differs."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    expected = rows_of(names, relation.fetchall())
    actual = rows_of(spark_df.columns, spark_df.collect())
    if actual == expected:
        return None
    extra, missing = set(actual) - set(expected), set(expected) - set(actual)
    return (
        f"{len(actual)} rows, expected {len(expected)}; "
        f"only here {len(extra)} {sorted(extra)[:3]}; only there {len(missing)} {sorted(missing)[:3]}"
    )[:3000]
