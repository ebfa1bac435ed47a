"""Compare registered queries with their SQL counterparts in DuckDB.

``python tests/compare.py [folder] [query ...]``
"""

from __future__ import annotations

import datetime
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, datetime.datetime | datetime.date):
        return value.isoformat()
    return repr(value)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return normalised(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(connection, sql):
    result = connection.execute(sql)
    return normalised([d[0] for d in result.description], result.fetchall())


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from spotlift.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                  "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = connect(folder)
    oracles = oracle_sql()
    chosen = sys.argv[2:] or list(queries())
    bad = 0
    for name in chosen:
        start = time.time()
        got = spark_rows(queries()[name](spark, folder))
        took = time.time() - start
        if name not in oracles:
            verdict = "rows only"
        else:
            start = time.time()
            want = duckdb_rows(connection, oracles[name])
            verdict = "ok" if got == want else "DIFFERS"
            verdict += f" (sql {time.time() - start:.2f}s)"
            if got != want:
                bad += 1
                print(got[0], want[0], len(got[1]), len(want[1]))
                print([r for r in got[1] if r not in set(want[1])][:3], [r for r in want[1] if r not in set(got[1])][:3])
        print(f"{name:30} {len(got[1]):7} rows {took:6.2f}s {verdict}", flush=True)
    print("all equal" if not bad else f"{bad} differ")
