"""Run registered queries and their SQL side by side and compare the rows.

Usage: python tools/check_queries.py [scale-factor folder] [query name ...]
"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catalog import QUERIES, SQL  # noqa: E402
from tarjuman.session import local_session  # noqa: E402


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(sf)):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{sf}/{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr), sorted(names)


def compare(df, con, sql: str) -> str:
    got, got_names = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want, want_names = rows_of(names, cursor.fetchall())
    if got_names != want_names:
        return f"columns differ: {got_names} against {want_names}"
    if len(got) != len(want):
        return f"row counts differ: {len(got)} against {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first:\n  {str(wrong[0][0])[-600:]!r}\n  {str(wrong[0][1])[-600:]!r}"
    return ""


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(8), connect(sf)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf)
            problem = compare(df, con, SQL[name]) if name in SQL else f"no SQL, {df.count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'ok  ' if not problem else 'BAD '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")


if __name__ == "__main__":
    main()
