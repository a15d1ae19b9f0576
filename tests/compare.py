"""Spark frames against DuckDB results: columns by name, types, and rows in any order."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# DuckDB's name for each Spark type in use.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def sorted_rows(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.reindex(sorted(frame.columns), axis=1)
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def assert_equal(df, db, sql: str) -> int:
    described = {name: kind for name, kind, *_ in db.execute(f"describe {sql}").fetchall()}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == described
    got, want = sorted_rows(df.toPandas()), sorted_rows(db.execute(sql).df())
    pd.testing.assert_frame_equal(got, want, check_exact=True, check_dtype=False)
    return len(want)
