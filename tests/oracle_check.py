"""Compare a Spark query with its DuckDB oracle on the same Parquet tables.

Mirrors the driver's gate: row count, column names, coarse types and an
order-insensitive comparison of every value.  Test-side helper: results
are small by construction (the sf0.001 / sf0.01 fixtures).
"""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import DataFrame

from orderlens.sources.star import STAR_TABLES

_KIND = {
    "bigint": "int", "int": "int", "integer": "int", "smallint": "int", "tinyint": "int",
    "hugeint": "int", "double": "float", "float": "float", "string": "str",
    "varchar": "str", "date": "date", "boolean": "bool", "timestamp": "ts",
    "timestamp_ntz": "ts",
}


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in STAR_TABLES:
        con.execute(
            f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if v != v:
            return (1, "nan")
        return (1, repr(float(v)))
    if isinstance(v, decimal.Decimal):
        return (1, repr(float(v)))
    if isinstance(v, (dt.datetime, dt.date)):
        return (2, v.isoformat())
    if isinstance(v, bool):
        return (3, str(v))
    if isinstance(v, int):
        return (4, str(v))
    return (5, str(v))


def _kind(t: str) -> str:
    t = t.lower().split("(")[0]
    return _KIND.get(t, "dec" if t.startswith("decimal") else t)


def compare(df: DataFrame, con, sql: str) -> dict:
    """Return a report dict with ``ok`` and the first differences."""
    spark_cols = df.columns
    spark_types = [_kind(f.dataType.simpleString()) for f in df.schema.fields]
    spark_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    duck_cols = list(rel.columns)
    duck_types = [_kind(str(t)) for t in rel.types]
    duck_rows = rel.fetchall()
    report = {"spark_rows": len(spark_rows), "oracle_rows": len(duck_rows)}
    report["columns_ok"] = sorted(spark_cols) == sorted(duck_cols)
    if report["columns_ok"]:
        order = [duck_cols.index(c) for c in spark_cols]
        duck_rows = [tuple(r[i] for i in order) for r in duck_rows]
        duck_types = [duck_types[i] for i in order]
    report["types_ok"] = spark_types == duck_types
    a = sorted(tuple(_norm(v) for v in r) for r in spark_rows)
    b = sorted(tuple(_norm(v) for v in r) for r in duck_rows)
    report["values_ok"] = a == b
    if not report["values_ok"]:
        sa, sb = set(a), set(b)
        report["only_spark"] = sorted(sa - sb)[:3]
        report["only_oracle"] = sorted(sb - sa)[:3]
    if not report["types_ok"]:
        report["types"] = (list(zip(spark_cols, spark_types)), duck_types)
    if not report["columns_ok"]:
        report["cols"] = (spark_cols, duck_cols)
    report["ok"] = (report["columns_ok"] and report["types_ok"] and report["values_ok"]
                    and len(spark_rows) == len(duck_rows))
    return report
