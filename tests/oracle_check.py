"""Compare acceptance queries with their SQL: ``python tests/oracle_check.py [sf_dir] [names...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if hasattr(value, "tzinfo") and getattr(value, "tzinfo", None) is not None:
        return value.replace(tzinfo=None)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(df, con, sql):
    """None when equal, else a short description of the difference."""
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        extra, lacking = got - want, want - got
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; "
            f"only Spark {list(extra)[:2]}; only SQL {list(lacking)[:2]}"
        )
    return None


def main():
    from conftest import make_session

    import __spark_entry__ as e

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(e.oracle_sql())
    spark, con = make_session(), duck(sf_dir)
    bad = 0
    for name in wanted:
        began = time.time()
        try:
            df = e.queries()[name](spark, sf_dir)
            problem = compare(df, con, e.oracle_sql()[name])
        except Exception as ex:
            problem = f"{type(ex).__name__}: {str(ex)[:1500]}"
        bad += problem is not None
        print(f"{name:26s} {time.time() - began:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} equal")


if __name__ == "__main__":
    main()
