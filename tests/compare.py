"""Run a registered query and its SQL on the same parquet files and compare rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from tracewell.sources.tables import TABLE_NAMES


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        value = float(f"{value:.9g}")
        return 0.0 if value == 0 else value
    if isinstance(value, int):
        return float(f"{value:.9g}") if abs(value) > 1 << 53 else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def keyed(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, con, sql):
    result = con.execute(sql)
    sql_columns = [d[0] for d in result.description]
    sql_rows = keyed(sql_columns, result.fetchall())
    rows = keyed(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    problems = []
    if sorted(sql_columns) != sorted(spark_df.columns):
        problems.append(f"columns {sorted(spark_df.columns)} vs {sorted(sql_columns)}")
    if len(rows) != len(sql_rows):
        problems.append(f"rows {len(rows)} vs {len(sql_rows)}")
    bad = [(a, b) for a, b in zip(rows, sql_rows) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: {bad[0]}")
    return len(rows), problems
