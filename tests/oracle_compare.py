"""Spark result vs DuckDB oracle: row count, column names and kinds, and an
order-insensitive comparison of the values (columns sorted by name)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from revlens.sources.tables import TEST_TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _kind(dtype) -> str:
    s = str(dtype).lower()
    if "int" in s:
        return "int"
    if "float" in s or "double" in s:
        return "float"
    if "bool" in s:
        return "bool"
    return "other"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            return int(v)
        return v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    if isinstance(v, (int, str, bool)):
        return v
    return str(v)


def _rows(pdf: pd.DataFrame) -> list:
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    return sorted((tuple(_norm(v) for v in r) for r in pdf.itertuples(index=False, name=None)),
                  key=repr)


def compare(spark_df, sql: str, con) -> dict:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    res = {
        "rows_spark": len(s), "rows_oracle": len(d),
        "columns_match": sorted(s.columns) == sorted(d.columns),
    }
    res["rows_match"] = len(s) == len(d)
    if res["columns_match"]:
        # pandas holds integers with NULLs as floats: the Spark type decides.
        whole = {f.name for f in spark_df.schema if f.dataType.typeName() in ("byte", "short", "integer", "long")}
        ks = {c: "int64" if c in whole and str(s[c].dtype) == "float64" else str(s[c].dtype).lower() for c in s.columns}
        kd = {c: str(d[c].dtype).lower() for c in d.columns}
        res["kinds"] = {c: (ks[c], kd[c]) for c in ks
                        if ks[c] != kd[c] and not (_kind(ks[c]) == _kind(kd[c]) == "other")}
        rs, rd = _rows(s), _rows(d)
        res["values_match"] = rs == rd
        if not res["values_match"]:
            diff = [(a, b) for a, b in zip(rs, rd) if a != b][:5]
            res["first_diffs"] = diff
    else:
        res["spark_cols"] = sorted(s.columns)
        res["oracle_cols"] = sorted(d.columns)
        res["values_match"] = False
    res["ok"] = (res["rows_match"] and res["columns_match"] and res["values_match"]
                 and not res.get("kinds"))
    return res
