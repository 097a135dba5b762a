"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import math
import os

import duckdb
import numpy as np
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value) -> str:
    if isinstance(value, np.ndarray):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_cell(v) for v in value) + "]"
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, (bool, np.bool_)):
        return str(bool(value))
    if isinstance(value, (float, np.floating)):
        return repr(float(value)) if not float(value).is_integer() else str(int(value))
    if isinstance(value, (int, np.integer)):
        return str(int(value))
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)


def canonical(pdf: pd.DataFrame) -> list[tuple[str, ...]]:
    columns = sorted(pdf.columns)
    return sorted(tuple(_cell(v) for v in row) for row in pdf[columns].itertuples(index=False, name=None))


def kinds(pdf: pd.DataFrame) -> dict[str, str]:
    return {c: str(t) for c, t in pdf.dtypes.items()}


def differences(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> list[str]:
    found = []
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return [f"columns {sorted(spark_pdf.columns)} != {sorted(sql_pdf.columns)}"]
    if len(spark_pdf) != len(sql_pdf):
        found.append(f"rows {len(spark_pdf)} != {len(sql_pdf)}")
    a, b = canonical(spark_pdf), canonical(sql_pdf)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        found.append(f"{len(only_a)} rows only in spark, {len(only_b)} only in sql; "
                     f"{only_a[:2]} / {only_b[:2]}")
    return found
