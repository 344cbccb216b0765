"""Run registered queries next to their SQL twin in DuckDB and compare rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    return v


def compare(spark, con, name, fn, sql, sf_dir):
    got = fn(spark, sf_dir)
    columns = sorted(got.columns)
    got_rows = sorted(
        (tuple(normal(r[c]) for c in columns) for r in got.collect()), key=lambda t: str(t)
    )
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    at = [names.index(c) for c in columns] if sorted(names) == columns else None
    if at is None:
        return f"columns {columns} != {sorted(names)}"
    want = sorted(
        (tuple(normal(r[i]) for i in at) for r in cursor.fetchall()), key=lambda t: str(t)
    )
    if len(got_rows) != len(want):
        return f"{len(got_rows)} rows, SQL gives {len(want)}"
    for a, b in zip(got_rows, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{dict(zip(columns, a))} != {dict(zip(columns, b))}"
    return None


def main(sf_dir: str, wanted: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tidemark.session import local_session

    spark = local_session(8, **{"spark.ui.showConsoleProgress": "false"})
    con = connect(sf_dir)
    bad = 0
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, name, fn, oracles[name], sf_dir)
            else:
                problem = None if fn(spark, sf_dir).count() else "no rows"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        kind = "ok  " if problem is None else "FAIL"
        print(f"{kind} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
