"""Side-by-side run of the registered queries and their SQL twins."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(normal(r[i]) for i in order) for r in rows]
    body.sort(key=lambda r: tuple((v is None, type(v).__name__, str(v)) for v in r))
    return [columns[i] for i in order], body


def compare(spark, con, key, query, sql, folder):
    """(rows, seconds, problem or None)"""
    began = time.time()
    df = query(spark, folder)
    spark_cols, spark_rows = df.columns, df.collect()
    seconds = time.time() - began
    mine = table_of(spark_cols, [tuple(r) for r in spark_rows])
    if sql is None:
        return len(spark_rows), seconds, None
    rel = con.sql(sql)
    theirs = table_of(rel.columns, rel.fetchall())
    if mine[0] != theirs[0]:
        return len(spark_rows), seconds, f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return len(spark_rows), seconds, f"rows {len(mine[1])} != {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return len(spark_rows), seconds, f"{mine[0]}: {a} != {b}"
    return len(spark_rows), seconds, None


if __name__ == "__main__":
    import sys

    from __spark_entry__ import oracle_sql, queries
    from funnelloom.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles = oracle_sql()
    bad = 0
    for key, fn in queries().items():
        if wanted and not any(key == w or (w.endswith("*") and key.startswith(w[:-1])) for w in wanted):
            continue
        try:
            rows, seconds, problem = compare(spark, con, key, fn, oracles.get(key), folder)
        except Exception as exc:  # noqa: BLE001
            rows, seconds, problem = 0, 0.0, f"{type(exc).__name__}: {str(exc)[:1500]}"
        note = "" if rows else " EMPTY"
        tag = "no-oracle" if key not in oracles else "ok"
        bad += problem is not None or not rows
        print(f"{key:32s} {rows:7d} {seconds:6.2f}s {problem or tag}{note}", flush=True)
    print("bad:", bad)
