"""Run a named query on Spark and its SQL on DuckDB, and compare the rows.

python tests/oracle.py [sf] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
DATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        return repr(v + 0.0) if v != int(v) or abs(v) > 1e15 else str(int(v))
    return str(v)


def _rows(records, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in records)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences in columns, types, row count or values; empty when equal."""
    got = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    types = {c[0]: str(c[1]) for c in cur.description}
    want = cur.fetchall()
    if sorted(columns) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} / {sorted(columns)}"]
    kinds = {
        "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    }
    out = [
        f"type of {n}: {k} / {types[n]}"
        for n, k in spark_df.dtypes
        if kinds.get(k, k) != types[n]
    ]
    if len(got) != len(want):
        return out + [f"rows {len(got)} / {len(want)}"]
    a, b = _rows(got, spark_df.columns), _rows(want, columns)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        out.append(f"{len(bad)} rows differ, first {bad[0]}")
    return out


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tests.conftest import make_session
    from tillroll.plans import PLANS

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(PLANS)
    sf_dir = f"{DATA}/sf{sf}"
    spark, con = make_session(), connect(sf_dir)
    failed = 0
    for name in names:
        p, t0 = PLANS[name], time.time()
        try:
            df = p(spark, sf_dir)
            if p.sql:
                diff = compare(df, con, p.sql)
            else:
                diff = [] if df.count() else ["no rows"]
        except Exception as e:  # noqa: BLE001
            diff = [f"{type(e).__name__}: {str(e)[:600]}"]
        failed += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name} {time.time() - t0:.1f}s", *diff, flush=True)
    print(f"{len(names) - failed} of {len(names)} agree", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
