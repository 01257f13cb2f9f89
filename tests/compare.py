"""Runs registered queries in Spark and their SQL in DuckDB and compares them."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9)
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


def spark_result(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cur = con.execute(sql)
    return normal([d[0] for d in cur.description], cur.fetchall())


def difference(got, want):
    """None when equal, else a short account."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return None
    g, w = set(got[1]), set(want[1])
    return (
        f"rows {len(got[1])} != {len(want[1])}; only spark {sorted(g - w, key=str)[:3]}; "
        f"only sql {sorted(w - g, key=str)[:3]}"
    )


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from threadsift.session import local_session

    sf, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(sf)
    sql = entry.oracle_sql()
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        if name not in sql:
            print(f"{name:28s} rows-only", run(spark, sf).count(), flush=True)
            continue
        start = time.time()
        try:
            got = spark_result(run(spark, sf))
            mid = time.time()
            bad = difference(got, duck_result(con, sql[name]))
            print(f"{name:28s} {'ok ' if bad is None else 'BAD'} {len(got[1]):7d} "
                  f"{mid - start:6.2f}s {time.time() - mid:6.2f}s {bad or ''}"[:900], flush=True)
        except Exception as exc:  # noqa: BLE001
            print(f"{name:28s} FAIL {str(exc)[:600]}", flush=True)
