"""Compare registered queries with their SQL twins in DuckDB.

Run ``python -m tests.oracle <sf_dir> [name ...]`` for a table of matches and timings.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _plain(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v + 0.0 if v != 0 else 0.0
    if isinstance(v, int):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, _plain(x)) for k, x in v.items())
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def run_sql(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    return [(d[0], str(d[1])) for d in cur.description], cur.fetchall()


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


_SAME = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def compare(spark, entry, sf_dir):
    """None when equal, else a short description of the first difference."""
    df = entry.plan(spark, sf_dir)
    got_names = df.columns
    got = rows_of(got_names, [tuple(r) for r in df.collect()])
    if entry.sql is None:
        return None if got else "no rows"
    described, rows = run_sql(sf_dir, entry.sql)
    names = [n for n, _ in described]
    if sorted(names) != sorted(got_names):
        return f"columns {sorted(got_names)} != {sorted(names)}"
    if len(got_names) != len(set(got_names)):
        return "duplicate columns"
    want = rows_of(names, rows)
    if len(want) != len(got):
        return f"rows {len(got)} != {len(want)}"
    sql_types = dict(described)
    types = [(n, t, sql_types[n]) for n, t in df.dtypes if _SAME.get(sql_types[n], t) != t]
    for a, b in zip(got, want):
        if a != b:
            diff = [(n, x, y) for n, x, y in zip(sorted(names), a, b) if x != y]
            return f"values {diff[:4]}"
    return f"types {types}" if types else (None if got else "no rows")


def main(argv):
    from secflow.plans import load_all
    from secflow.session import local_session

    spark = local_session(8)
    entries = load_all()
    names = []
    for a in argv[1:]:
        names += [n for n in entries if n == a or entries[n].plan.__module__.endswith(a)]
    names = names or list(entries)
    bad = 0
    for n in names:
        t = time.time()
        try:
            problem = compare(spark, entries[n], argv[0])
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__} {str(e)[:1500]}"
        bad += problem is not None
        kind = "sql" if entries[n].sql else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - t:6.2f}s {kind} {n} {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")


if __name__ == "__main__":
    main(sys.argv[1:])
