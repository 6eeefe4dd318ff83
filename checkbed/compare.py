"""Compare a Spark result with DuckDB on the same tables, ignoring row order."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def difference(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """First difference as text, None if the frames hold the same rows."""
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(set(actual.columns) ^ set(expected.columns))}"
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    columns = sorted(actual.columns)
    left, right = _normal(actual[columns]), _normal(expected[columns])
    for name in columns:
        if sorted(left[name]) != sorted(right[name]):
            gone = sorted(set(right[name]) - set(left[name]))[:3]
            new = sorted(set(left[name]) - set(right[name]))[:3]
            return f"column {name}: extra {new} missing {gone}"
    if sorted(map(tuple, left.values)) != sorted(map(tuple, right.values)):
        return "rows differ"
    return None


def _normal(df: pd.DataFrame) -> pd.DataFrame:
    return df.apply(lambda col: col.map(_text))


def _text(value) -> str:
    if value is None or value is pd.NaT or value is pd.NA:
        return "~"
    if isinstance(value, float):
        return "~" if value != value else repr(float(value)) if value % 1 else str(int(value))
    if isinstance(value, (bool,)) or type(value).__name__ == "bool_":
        return str(bool(value))
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)
