"""Compare a query with its SQL on the test tables: python -m tests.llm.oracle NAME FOLDER."""

import sys
import time

import duckdb

TABLES = ("documents", "pages", "labels", "conversations", "benchmark")


def rows(name, spark, folder):
    """Both results as sorted lists of rows, columns by name."""
    import __spark_entry__ as entry

    frame = entry.queries()[name](spark, folder)
    columns = sorted(frame.columns)
    ours = sorted(map(tuple, frame.select(*columns).collect()), key=repr)
    base = duckdb.connect()
    for table in TABLES:
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    listed = ", ".join(f'"{c}"' for c in columns)
    theirs = base.execute(f"SELECT {listed} FROM ({entry.oracle_sql()[name]})").fetchall()
    return columns, ours, sorted(theirs, key=repr)


if __name__ == "__main__":
    from clickloom.session import build_session

    session = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                            spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    for query in sys.argv[1].split(","):
        began = time.time()
        columns, a, b = rows(query, session, sys.argv[2])
        print(query, "same" if a == b else "DIFFERENT", len(a), len(b), round(time.time() - began, 1))
        if a != b:
            for x, y in [(x, y) for x, y in zip(a, b) if x != y][:3]:
                print(columns, x, y, sep="\n")
