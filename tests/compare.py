"""Runs queries against their SQL in DuckDB: python tests/compare.py FOLDER [NAME...]."""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def duck(folder: str):
    import duckdb

    c = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        source = f"{p}/*.parquet" if p.is_dir() else str(p)
        c.execute(f"create view {p.stem} as select * from '{source}'")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if v != v else v + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def compare(spark, folder: str, name: str, fn, sql: str) -> str:
    """An empty text if both give the same columns and rows, else what differs."""
    df = fn(spark, folder)
    names = sorted(df.columns)
    ours = Counter(tuple(plain(v) for v in r) for r in df.select(*names).collect())
    c = duck(folder)
    result = c.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"columns {names} against {sorted(columns)}"
    order = [columns.index(n) for n in names]
    theirs = Counter(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    if ours == theirs:
        return ""
    return f"{sum(ours.values())} rows against {sum(theirs.values())}; ours only {list((ours - theirs).items())[:2]}, theirs only {list((theirs - ours).items())[:2]} of {sum((ours - theirs).values())}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from marlstone.session import build

    spark = build()
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or list(queries):
        began = time.time()
        try:
            if name in oracle:
                found = compare(spark, sys.argv[1], name, queries[name], oracle[name]) or "equal"
            else:
                found = f"no SQL, {queries[name](spark, sys.argv[1]).count()} rows"
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{name}: {found} ({time.time() - began:.1f} s)", flush=True)
