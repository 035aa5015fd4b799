"""Run registered queries next to their check SQL.  python tests/compare.py [sf] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
DATA = os.environ.get("MARQUEE_TESTDATA", "/root/testdata")


def duck(folder: str):
    import duckdb

    con = duckdb.connect(config={"memory_limit": "6GB"})
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else ("f", round(v, 6) + 0.0)
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, int):
        return ("i", v)
    return str(v)


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_cell(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, folder, name, fn, sql):
    start = time.time()
    df = fn(spark, folder)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    if sql is None:
        return ("rows-only" if got else "EMPTY"), len(got), seconds, 0.0, None
    start = time.time()
    cur = con.execute(sql)
    want_cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    sql_seconds = time.time() - start
    if sorted(df.columns) != sorted(want_cols):
        return "COLUMNS", len(got), seconds, sql_seconds, (sorted(df.columns), sorted(want_cols))
    a, b = normal(got, df.columns), normal(want, want_cols)
    if a == b:
        return ("ok" if a else "EMPTY"), len(a), seconds, sql_seconds, None
    in_a, in_b = set(a), set(b)
    left = [x for x in a if x not in in_b][:3]
    right = [x for x in b if x not in in_a][:3]
    return "DIFF", len(a), seconds, sql_seconds, (len(b), left, right)


def main() -> int:
    import __spark_entry__ as entry
    from marquee.session import build_session

    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    folder = f"{DATA}/sf{sf}"
    spark = build_session("compare", "local[8]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    checks = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if args[1:] and not any(name.startswith(a) for a in args[1:]):
            continue
        try:
            state, rows, secs, sql_secs, info = compare(spark, con, folder, name, fn, checks.get(name))
        except Exception as e:  # report and go on with the next query
            state, rows, secs, sql_secs, info = "ERROR", 0, 0.0, 0.0, str(e)[:500]
        bad += state.isupper()
        print(f"{state:9s} {name:32s} rows={rows:<8d} spark={secs:6.2f}s sql={sql_secs:6.2f}s", info or "", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
