"""Runs queries next to their oracles: ``python -m workloads.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from registria.session import local_session
from . import registered

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings"
          " pages benchmark labels conversations").split()


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None if both agree, else what differs."""
    df = registered.QUERIES[name](spark, sf_dir)
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(registered.ORACLES[name])
    columns = [d[0] for d in rel.description]
    want = sorted_rows(columns, rel.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; {got[:2]} / {want[:2]}"
    if not got:
        return "empty on both sides"
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            return f"{a!r} != {b!r}"
    return None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(registered.QUERIES)
    spark, con, bad = local_session("compare", 8), oracle(sf_dir), 0
    for name in names:
        begun = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - begun:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
