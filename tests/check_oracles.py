"""Compare every registered query with its SQL: ``python tests/check_oracles.py [sf_dir] [prefix ...]``."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from orebed.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float) and v == int(v) and abs(v) < 1e15:
        return f"{v:.1f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(cell(x) for x in v) + "]"
    return repr(v)


def table_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def compare(spark, con, sf, name, fn, sql):
    """Message about the first difference, or None."""
    df = fn(spark, sf)
    got = table_of(df.collect(), df.columns)
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = table_of(cur.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}" if bad else None


def main():
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    picks = args[1:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf)
    oracle, failed = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if picks and not any(name.startswith(p) for p in picks):
            continue
        t = time.time()
        try:
            msg = compare(spark, con, sf, name, fn, oracle.get(name))
        except Exception as e:  # noqa: BLE001
            msg = f"{type(e).__name__}: {str(e)[:600]}"
        failed += msg is not None
        kind = "" if name in oracle else " (rows only)"
        print(f"{'FAIL' if msg else 'ok  '} {name}{kind} {time.time() - t:.1f}s {msg or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
