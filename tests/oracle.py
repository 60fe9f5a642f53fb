"""Compare registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _kind(dtype) -> str:
    if pd.api.types.is_bool_dtype(dtype):
        return "bool"
    if pd.api.types.is_integer_dtype(dtype):
        return "int"
    if pd.api.types.is_float_dtype(dtype):
        return "float"
    return "other"


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    columns = sorted(pdf.columns)
    rows = [
        tuple(None if pd.isna(v) else (repr(float(v)) if isinstance(v, float) else str(v)) for v in row)
        for row in pdf[columns].itertuples(index=False, name=None)
    ]
    return sorted(rows, key=str)


def difference(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> str | None:
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} != {sorted(sql_pdf.columns)}"
    if len(spark_pdf) != len(sql_pdf):
        return f"rows {len(spark_pdf)} != {len(sql_pdf)}"
    for c in spark_pdf.columns:
        a, b = _kind(spark_pdf[c].dtype), _kind(sql_pdf[c].dtype)
        if a == "int" and b == "float":
            spark_pdf = spark_pdf.assign(**{c: spark_pdf[c].astype(float)})
        if b == "int" and a == "float":
            sql_pdf = sql_pdf.assign(**{c: sql_pdf[c].astype(float)})
        if str(spark_pdf[c].dtype).startswith("datetime") or str(sql_pdf[c].dtype).startswith("datetime"):
            spark_pdf = spark_pdf.assign(**{c: pd.to_datetime(spark_pdf[c]).astype("datetime64[us]")})
            sql_pdf = sql_pdf.assign(**{c: pd.to_datetime(sql_pdf[c]).astype("datetime64[us]")})
    mine, theirs = canonical(spark_pdf), canonical(sql_pdf)
    wrong = [(x, y) for x, y in zip(mine, theirs) if x != y]
    if not wrong:
        return None
    columns = sorted(spark_pdf.columns)
    first = [(c, x, y) for c, x, y in zip(columns, *wrong[0]) if x != y]
    return f"{len(wrong)} of {len(mine)} rows differ, first: {first[:6]}"
