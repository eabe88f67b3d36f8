"""Compare registered queries with their SQL twins in DuckDB, values and multiplicities."""

from __future__ import annotations

import collections
import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


def duck(sf: str):
    import duckdb

    db = duckdb.connect()
    for name in TABLES.split():
        db.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.date):
        return str(value)
    return value


def difference(spark, db, name: str, build, text: str, sf: str) -> str | None:
    """None when equal, otherwise what differs."""
    df = build(spark, sf)
    columns = sorted(df.columns)
    got = collections.Counter(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    cursor = db.execute(text)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = collections.Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
    if got == want:
        return None if sum(got.values()) else "EMPTY"
    more, less = got - want, want - got
    return (
        f"rows {sum(got.values())} vs {sum(want.values())}; {columns}\n  only spark {list(more.items())[:2]}"
        f"\n  only sql   {list(less.items())[:2]}"
    )


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tidemark.session import build_session

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    db, oracle = duck(sf), entry.oracle_sql()
    for name, build in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            verdict = difference(spark, db, name, build, oracle[name], sf) if name in oracle else "no sql"
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {time.time() - start:.1f}s {verdict or ''}", flush=True)
