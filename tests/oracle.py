"""Runs registered queries and their check SQL side by side.

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)
    if hasattr(value, "normalize") and hasattr(value, "as_tuple"):
        return plain(float(value))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """None if equal, else what differs."""
    got = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first: {bad[0]}"
    return None if a else "EMPTY"


def main(argv):
    import __spark_entry__ as contract
    from tidewatch.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, checks = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in argv[1:] or list(queries):
        began = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in checks:
                problem = compare(df, con, checks[name])
            else:
                problem = None if df.collect() else "EMPTY"
        except Exception as exc:  # report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        failed += problem is not None
        kind = "sql " if name in checks else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - began:6.2f}s {name} {problem or ''}", flush=True)
    print("failed:", failed, "of", len(argv[1:] or queries))
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
