"""Run queries in Spark and their SQL in DuckDB and compare the rows.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def cell(value):
    if value is None:
        return "\0"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0) if value != int(value) or abs(value) > 1e15 else str(int(value))
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> str | None:
    """None if equal, else what differs."""
    res = con.execute(sql)
    want_cols, want = table([d[0] for d in res.description], res.fetchall())
    got_cols, got = table(df.columns, [tuple(r) for r in df.collect()])
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(want)} rows differ, first {bad[0]}" if bad else None


def main() -> int:
    import __spark_entry__ as entry
    from foliar.session import local_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = local_session("8")
    con = connect(sf)
    jobs, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args or jobs:
        start = time.time()
        try:
            df = jobs[name](spark, sf)
            if name in oracle:
                problem = compare(df, con, oracle[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as err:  # noqa: BLE001
            problem = f"{type(err).__name__}: {str(err)[:700]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed of {len(args or jobs)}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
