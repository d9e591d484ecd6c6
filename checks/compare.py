"""Run registered queries in Spark and their SQL in DuckDB, and compare the rows.

``python -m checks.compare [sf_dir] [query ...]``
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    return v.tz_localize(None) if getattr(v, "tzinfo", None) else v


def difference(spark, con, name: str, sf_dir: str) -> tuple[int, str]:
    """(rows, description of the first differences or '')."""
    rows = QUERIES[name](spark, sf_dir)
    columns = sorted(rows.columns)
    got = Counter(tuple(r) for r in rows.select(*columns).collect())
    if name not in ORACLES:
        return sum(got.values()), ""
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    if [names[i] for i in order] != columns:
        return sum(got.values()), f"columns {columns} != {sorted(names)}"
    want = Counter(tuple(r[i] for i in order) for r in result.fetchall())
    extra, missing = got - want, want - got
    if not extra and not missing:
        return sum(got.values()), ""
    return sum(got.values()), (
        f"{sum(extra.values())} extra, {sum(missing.values())} missing of {sum(want.values())}:\n"
        f"  {columns}\n  spark {sorted(extra, key=str)[:2]}\n  duckdb {sorted(missing, key=str)[:2]}"
    )


def main(argv: list[str]) -> int:
    from checks.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con, bad = local_session(), connect(sf_dir), 0
    for name in argv[1:] or QUERIES:
        start = time.perf_counter()
        try:
            n, problem = difference(spark, con, name, sf_dir)
        except Exception as error:  # report and go on to the next query
            n, problem = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        status, took = "FAIL" if problem else "ok", time.perf_counter() - start
        print(f"{status:4} {name:26} {n:8} rows {took:6.2f}s", problem, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
