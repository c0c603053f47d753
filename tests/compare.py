"""Run queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import decimal
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


# Joins that form all pairs, and row-wise Python.
UNWANTED = ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas", "FlatMapGroups")


def difference(spark, connection, folder, run, sql) -> str | None:
    """None when both sides agree, else a description."""
    df = run(spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for name in UNWANTED:
        if name in plan:
            return f"{name} in the plan"
    found = rows_of(df.columns, df.collect())
    if sql is None:
        return None if sum(found.values()) else "no rows"
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    if found == expected:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"{sum(found.values())} rows against {sum(expected.values())}; "
        f"only here {list(extra)[:2]}, only there {list(missing)[:2]}"
    )


if __name__ == "__main__":
    from tidemark.queries import ORACLES, QUERIES
    from tidemark.session import local_session

    folder = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("OFF")
    connection = duck(folder)
    bad = 0
    for name in names:
        begin = time.time()
        try:
            problem = difference(spark, connection, folder, QUERIES[name], ORACLES.get(name))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - begin:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(names)} queries, {bad} differ")
