"""Compare every query with its SQL: row count, column names and values."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = ["events", "pages"]


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_value(row[i]) for i in order) for row in rows)


def connect(tables: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return con


def compare(df, con, sql: str) -> str | None:
    """What differs, or None."""
    names, ours = _rows(df.columns, df.collect())
    cursor = con.execute(sql)
    other_names, theirs = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if names != other_names:
        return f"columns {names} / {other_names}"
    if ours != theirs:
        return (f"{sum(ours.values())} / {sum(theirs.values())} rows; only ours "
                f"{list((ours - theirs).items())[:2]}; only theirs {list((theirs - ours).items())[:2]}")
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from clickloom.session import build_session

    tables = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    wanted = sys.argv[2:]
    spark = build_session("oracle-check", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", os.environ.get("CHECK_ZONE", "UTC"))
    con, sql = connect(tables), oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            df = query(spark, tables)
            result = compare(df, con, sql[name]) if name in sql else f"rows only: {len(df.collect())}"
        except Exception as error:  # report and go on with the next query
            result = f"ERROR {str(error)[:600]}"
        print(f"{name:34s} {time.time() - began:6.2f}s  {result or 'ok'}", flush=True)
