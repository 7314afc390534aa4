"""Run registered queries against their SQL and report differences.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

from .oracle import oracle_sql
from .queries import queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), str(v)) for v in row)


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """None if both sides return the same rows, else a short description."""
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=_key)
    cur = con.execute(oracle_sql()[name])
    theirs_columns = [d[0] for d in cur.description]
    if sorted(theirs_columns) != columns:
        return f"columns {columns} != {sorted(theirs_columns)}"
    order = [theirs_columns.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=_key)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"columns {columns}\n  spark {a}\n  sql   {b}"
    return None


def main(argv: list[str]) -> int:
    from waybill.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            diff = difference(spark, con, sf_dir, name)
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - start:.1f}s", flush=True)
        if diff:
            print("  " + diff, flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
