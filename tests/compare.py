"""Compare a Spark result with its SQL on DuckDB: column names, types, and rows in any order."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _type(t: pa.DataType) -> pa.DataType:
    """One form for the types that the engines write in several ways."""
    if pa.types.is_timestamp(t):
        return pa.timestamp("us")
    if pa.types.is_large_string(t) or str(t) == "string_view":
        return pa.string()
    return t


def _canonical(table: pa.Table) -> pa.Table:
    table = table.select(sorted(table.column_names))
    table = table.cast(pa.schema([(f.name, _type(f.type)) for f in table.schema]))
    return table.sort_by([(name, "ascending") for name in table.column_names])


def differences(spark_df, con, sql: str) -> str | None:
    """None if equal, otherwise a short description of the first difference."""
    actual, expected = _canonical(spark_df.toArrow()), _canonical(con.sql(sql).to_arrow_table())
    if actual.column_names != expected.column_names:
        return f"columns {actual.column_names} != {expected.column_names}"
    types = [(a.name, a.type, b.type) for a, b in zip(actual.schema, expected.schema) if a.type != b.type]
    if types:
        return f"types {types}"
    if actual.num_rows != expected.num_rows:
        return f"{actual.num_rows} rows != {expected.num_rows}"
    if actual.equals(expected):
        return None
    for a, b in zip(actual.to_pylist(), expected.to_pylist()):
        if a != b:
            return f"row {a} != {b}"
    return None
