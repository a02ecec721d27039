"""Run a registered query on Spark and its oracle on DuckDB, compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Comparison: same column names, same row count, same multiset of rows after
normalising values (decimals by value, timestamps/dates ISO, floats rounded).
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return ("d", v.normalize() if v == v else str(v))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("d", decimal.Decimal(v).normalize())
    if isinstance(v, float):
        return ("d", decimal.Decimal(repr(round(v, 9))).normalize())
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("t", dt.datetime(v.year, v.month, v.day).isoformat())
    return ("s", str(v))


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns differ: spark={sorted(scols)} duck={sorted(dcols)}")
    if len(srows) != len(drows):
        problems.append(f"rows differ: spark={len(srows)} duck={len(drows)}")
    if not problems:
        a, b = canon(srows, scols), canon(drows, dcols)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return problems, len(srows), t1 - t0, t2 - t1


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from ledgerloom.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print(f"ROWS-ONLY {name}: {df.count()} rows")
            continue
        problems, n, ts, td = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        status = "OK  " if not problems else "FAIL"
        bad += bool(problems)
        print(f"{status} {name}: {n} rows spark {ts:.1f}s duck {td:.1f}s {'; '.join(problems)}", flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
