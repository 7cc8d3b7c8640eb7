"""Runs registered queries next to their SQL in DuckDB and compares the rows.

    python -m tests.oracle [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

from __spark_entry__ import oracle_sql, queries
from tidemark.workload.registry import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


KINDS = {
    "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int",
    "BIGINT": "int", "INTEGER": "int", "HUGEINT": "wide", "SMALLINT": "int", "TINYINT": "int",
    "double": "float", "float": "float", "DOUBLE": "float", "FLOAT": "float",
    "string": "text", "VARCHAR": "text", "boolean": "flag", "BOOLEAN": "flag",
}


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when rows, columns and kinds of type agree, else what differs."""
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(tuple(cell(r[c]) for c in columns) for r in df.collect())
    sql = oracle_sql().get(name)
    if sql is None:
        return None
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} vs {sorted(names)}"
    kinds = {n: KINDS.get(str(t), str(t)) for n, t in zip(names, [d[1] for d in result.description])}
    types = dict(df.dtypes)
    odd = [
        (c, types[c], kinds[c])
        for c in columns
        if KINDS.get(types[c], types[c]) != kinds[c] and kinds[c] not in ("NULL", '"NULL"')
    ]
    order = [names.index(c) for c in columns]
    want = Counter(tuple(cell(row[i]) for i in order) for row in result.fetchall())
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; {columns}\n"
            f"   only here {list(extra)[:3]}\n   only in SQL {list(missing)[:3]}"
        )
    return f"types {odd}" if odd else None


def main(argv: list[str]) -> int:
    from tidemark import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in argv[1:] or queries():
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} of {len(argv[1:] or queries())} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
