"""Run a query on Spark and its SQL on DuckDB and compare the values exactly."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, (list, tuple)) or hasattr(value, "tolist") and getattr(value, "ndim", 0):
        return str([plain(v) for v in value])
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(plain(v) for v in row) for row in frame.astype(object).itertuples(index=False, name=None))


def difference(left: pd.DataFrame, right: pd.DataFrame) -> str | None:
    """None if the frames hold the same rows, else what differs."""
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} != {sorted(right.columns)}"
    a, b = rows_of(left), rows_of(right)
    if a == b:
        return None
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {sorted(left.columns)}: {bad[0][0]} != {bad[0][1]}"
