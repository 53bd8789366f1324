"""Run every query beside its SQL twin: ``python tests/compare.py [data folder] [query ...]``."""

import datetime as dt
import decimal
import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir):
    db = duckdb.connect()
    db.execute(f"SET threads = {os.cpu_count() or 4}")
    for name in TABLES.split():
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def plain(value):
    """One spelling per value, so that equal values compare equal and nothing is rounded."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return repr(float(value))
    if isinstance(value, dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S")
    return str(value)


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def check(spark, db, name, query, sql, sf_dir):
    """(rows, problem or None, seconds in Spark)."""
    start = time.time()
    df = query(spark, sf_dir)
    got = normalized(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if sql is None:
        return len(got[1]), None, took
    cur = db.execute(sql)
    want = normalized([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return len(got[1]), f"columns {got[0]} != {want[0]}", took
    if got[1] != want[1]:
        a, b = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
        return len(got[1]), f"{len(got[1])} vs {len(want[1])} rows, {len(a)} differ: {sorted(a)[:2]} vs {sorted(b)[:2]}", took
    return len(got[1]), None, took


if __name__ == "__main__":
    from tillsight.session import local_session

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session, database = local_session("compare"), connect(folder)
    sqls, bad = entry.oracle_sql(), 0
    for key, fn in entry.queries().items():
        if sys.argv[2:] and key not in sys.argv[2:]:
            continue
        try:
            n, problem, secs = check(session, database, key, fn, sqls.get(key), folder)
        except Exception as e:  # keep going, report at the end
            n, problem, secs = -1, f"{type(e).__name__}: {str(e)[:600]}", 0.0
        bad += problem is not None
        kind = "rows" if key not in sqls else "sql"
        print(f"{'FAIL' if problem else 'ok  '} {kind:4} {key:32} {n:7d} rows {secs:6.2f}s {problem or ''}", flush=True)
    print("extra oracle keys:", sorted(set(sqls) - set(entry.queries())), "failures:", bad)
    session.stop()
