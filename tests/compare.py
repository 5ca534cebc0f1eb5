"""Runs registered queries and their SQL twins side by side.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "asDict"):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(_plain(x) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if type(v).__name__ == "Decimal":
        return float(f"{float(v):.9g}")
    if getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=repr
    )


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, sf_dir)
    sql = entry.oracle_sql().get(name)
    got_cols, got = rows_of(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    result = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            n = sum(a != b for a, b in zip(got, want))
            return f"{n} rows differ, first {g} != {w}"
    return None if got else "no rows"


def main(argv):
    from geoobs.session import local_session

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8, "compare")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = []
    for name in argv[1:] or entry.queries():
        began = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as exc:  # noqa: BLE001 - the report goes on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - began:6.2f}s {name} "
              f"{problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")


if __name__ == "__main__":
    main(sys.argv[1:])
