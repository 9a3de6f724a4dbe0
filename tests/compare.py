"""Run registered queries next to their SQL twins in DuckDB.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """What differs between a query and its twin, or None."""
    from quayside.queries import ORACLES, QUERIES

    df = QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = _rows(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    if not got:
        return "no rows at all"
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} and {b}"
    return None


def main() -> int:
    from quayside.queries import ORACLES, QUERIES
    from quayside.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        began = time.time()
        try:
            wrong = difference(spark, con, name, sf_dir) if name in ORACLES else "no twin"
        except Exception as error:
            wrong = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += wrong is not None
        print(f"{'FAIL' if wrong else 'ok  '} {time.time() - began:6.2f}s {name} {(wrong or '')[:1800]}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
