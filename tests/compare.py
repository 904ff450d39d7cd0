"""Run registered queries next to their SQL and compare the rows (python -m tests.compare [-d DIR] [name ...])."""

from __future__ import annotations

import argparse
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def oracle_rows(sql: str, folder: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    cursor = con.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def bag(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, folder: str, query, sql: str | None) -> tuple[int, str | None]:
    df = query(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return len(rows), None
    names, expected = oracle_rows(sql, folder)
    if sorted(names) != sorted(df.columns):
        return len(rows), f"columns {sorted(df.columns)} != {sorted(names)}"
    ours, theirs = bag(df.columns, rows), bag(names, expected)
    if ours == theirs:
        return len(rows), None
    return len(rows), (f"{len(rows)} rows, expected {len(expected)}\n"
                       f"   ours only  {list((ours - theirs).items())[:3]}\n   oracle only {list((theirs - ours).items())[:3]}")


def main() -> int:
    from millrace import build_session
    from millrace.plans import ORACLES, QUERIES

    parser = argparse.ArgumentParser()
    parser.add_argument("-d", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            n, problem = difference(spark, args.d, QUERIES[name], ORACLES.get(name))
        except Exception as error:  # report and go on with the next query
            n, problem = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        mark = "FAIL" if problem else ("ok  " if name in ORACLES else "rows")
        print(f"{mark} {name:28s} {n:7d} rows {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
