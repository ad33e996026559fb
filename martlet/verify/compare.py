"""Compare a Spark result with a DuckDB oracle result, order-insensitively."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duckdb_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    tz = os.environ.get("ORACLE_TZ", "UTC")
    con.execute(f"SET TimeZone = '{tz}'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)                      # exact: both engines compute IEEE doubles
    if isinstance(v, decimal.Decimal):
        return str(v)                       # exact, scale included (types are checked to match)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date, str, bool, int)):
        return str(v) if not isinstance(v, bool) else ("true" if v else "false")
    if isinstance(v, (list, tuple)):
        return str([_canon(x) for x in v])
    return str(v)


def canonical_rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_canon(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple("" if x is None else x for x in r))
    return cols, out


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                   "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                   "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_mismatches(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[tuple[str, str, str]]:
    """Columns whose Spark type does not map to the oracle's DuckDB type."""
    oracle = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [(c, t, oracle.get(c)) for c, t in spark_df.dtypes
            if oracle.get(c) != SPARK_TO_DUCKDB.get(t, t.upper())]


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols = list(spark_df.columns)
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    sc, sr = canonical_rows(s_cols, s_rows)
    dc, dr = canonical_rows(d_cols, d_rows)
    mismatched = type_mismatches(spark_df, con, sql)
    result = {"spark_rows": len(sr), "oracle_rows": len(dr), "columns_match": sc == dc and not mismatched,
              "values_match": sr == dr}
    if mismatched:
        result["type_mismatches"] = mismatched
    if sc != dc:
        result["spark_cols"], result["oracle_cols"] = sc, dc
    elif sr != dr:
        s_set, d_set = set(sr), set(dr)
        result["only_spark"] = sorted(s_set - d_set, key=str)[:3]
        result["only_oracle"] = sorted(d_set - s_set, key=str)[:3]
    return result
