"""Side-by-side check of the registered queries against DuckDB.

``python tests/compare.py [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _key(value):
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str) -> str:
    start = time.time()
    df = contract.queries()[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    spark_s = time.time() - start
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return f"ROWS  {name} {len(got)} rows {spark_s:.1f}s"
    start = time.time()
    rel = con.sql(sql)
    columns = rel.columns
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    want = rows_of(columns, rel.fetchall())
    duck_s = time.time() - start
    note = f"{name} {len(got)}/{len(want)} rows, spark {spark_s:.1f}s sql {duck_s:.1f}s"
    if sorted(columns) != sorted(df.columns):
        return f"DIFF  {note} columns {sorted(df.columns)} {sorted(columns)}"
    odd = {c: (t, duck_types[c]) for c, t in df.dtypes if duck_types[c] != TYPES[t]}
    if got == want:
        return f"DIFF  {note} types {odd}" if odd else f"OK    {note}"
    odd = [(a, b) for a, b in zip(got, want) if a != b][:2]
    return f"DIFF  {note} {str(odd)[:600]}"


def main() -> int:
    from brevia.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(contract.queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        try:
            line = compare(spark, con, folder, name)
        except Exception as e:  # report and go on
            line = f"FAIL  {name} {type(e).__name__} {str(e)[:700]}"
        bad += not line.startswith(("OK", "ROWS"))
        print(line, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
