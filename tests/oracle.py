"""Run queries against their SQL in DuckDB: python tests/oracle.py [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, fn, sql: str, sf: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = normal(df.columns, got), normal(names, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    types = {n: str(t) for n, t in ((d[0], d[1]) for d in cur.description)}
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"first difference\n  spark {str(x)[:1500]}\n  sql   {str(y)[:1500]}\n  types {types}"
    if not a:
        return "no rows"
    return None


def main() -> None:
    import __spark_entry__ as e
    from gleaner.session import local_session

    sf = "/root/testdata/sf0.01"
    spark = local_session("oracle", "8")
    con = duck(sf)
    wanted = sys.argv[1:] or list(e.queries())
    bad = []
    for name in wanted:
        fn, sql = e.queries()[name], e.oracle_sql().get(name)
        t = time.time()
        try:
            if sql is None:
                problem = None if fn(spark, sf).count() else "no rows"
            else:
                problem = compare(spark, con, name, fn, sql, sf)
        except Exception as ex:  # noqa: BLE001
            problem = f"{type(ex).__name__}: {str(ex)[:1200]}"
        mark = "ok" if problem is None else f"BAD {problem}"
        print(f"{name} {time.time() - t:.1f}s {mark}", flush=True)
        if problem:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main()
