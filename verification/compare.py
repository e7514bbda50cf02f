"""Run queries on Spark and their SQL on DuckDB and compare schema, row count and values.

    python -m verification.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

from riskweave import build_session
from riskweave.plans.catalog import QUERIES
from verification.oracle import SQL

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _sortable(row):
    return tuple((v is not None, str(v)) for v in row)


def compare(df, con, text: str) -> str:
    """Empty when equal, else what differs."""
    expected = con.execute(text)
    columns = {d[0]: str(d[1]).upper() for d in expected.description}
    rows = expected.fetchall()
    names = sorted(df.columns)
    if names != sorted(columns):
        return f"columns {set(names) ^ set(columns)}"
    types = dict(df.dtypes)
    wrong = {n: (types[n], columns[n]) for n in names if TYPES.get(types[n]) != columns[n]}
    order = [list(columns).index(n) for n in names]
    want = sorted((tuple(r[i] for i in order) for r in rows), key=_sortable)
    got = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_sortable)
    if len(want) != len(got):
        return f"rows spark {len(got)} sql {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return "value " + str({n: (x, y) for n, x, y in zip(names, a, b) if x != y})[:400]
    return f"types {wrong}" if wrong else ""


def main(folder: str, names: list[str]) -> int:
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    con = connect(folder)
    bad = 0
    for name in names or [n for n in QUERIES if n in SQL]:
        started = time.time()
        try:
            found = compare(QUERIES[name](spark, folder), con, SQL[name])
        except Exception as error:  # report and go on
            found = f"{type(error).__name__}: {str(error)[:500]}"
        bad += bool(found)
        print(f"{name:28s} {time.time() - started:6.2f}s  {found or 'ok'}", flush=True)
    print(f"{bad} differ; without SQL: {sorted(set(QUERIES) - set(SQL))}; SQL without query: {sorted(set(SQL) - set(QUERIES))}")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
