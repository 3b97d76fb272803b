"""Run queries against their SQL in DuckDB and report differences.

    python tests/compare.py [folder] [name-prefix ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, db, sql: str) -> str | None:
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns differ: {sorted(spark_df.columns)} / {sorted(names)}"
    want = rows_of(names, result.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got == want:
        return None if want else "EMPTY on both sides"
    only_got, only_want = list((got - want).elements()), list((want - got).elements())
    key = lambda r: str(r)
    return (
        f"{sum(got.values())} rows / {sum(want.values())} wanted; {len(only_got)} extra, {len(only_want)} missing\n"
        f"    columns {sorted(names)}\n    extra   {sorted(only_got, key=key)[:3]}\n    missing {sorted(only_want, key=key)[:3]}"
    )


def main() -> None:
    from ledgerflow.plans.registry import load
    from ledgerflow.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark, db = local_session(cpus=int(os.environ.get("BENCH_CPUS", "8"))), connect(folder)
    bad = 0
    for name, query in load().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = query.run(spark, folder)
            problem = difference(df, db, query.sql) if query.sql else (None if df.count() else "EMPTY")
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None and not problem.startswith("EMPTY")
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name}{'' if query.sql else ' (no SQL)'}{'' if problem is None else '  ' + problem}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
