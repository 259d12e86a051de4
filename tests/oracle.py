"""Compare registered queries with their SQL in DuckDB on the same tables.

Run by hand: ``python tests/oracle.py SF_DIR [query ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sys
import time


def normal(value):
    """One spelling per value, whatever engine it comes from."""
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, float):
        return "nan" if value != value else f"{value:.9g}"
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(normal(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def duck_rows(sql: str, sf: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in res.fetchall())


def difference(df, sql: str, sf: str) -> str | None:
    names, got = spark_rows(df)
    want_names, want = duck_rows(sql, sf)
    if names != want_names:
        return f"columns {names} instead of {want_names}"
    if got == want:
        return None
    only_got = [r for r in got if r not in set(want)][:2]
    only_want = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} rows instead of {len(want)}; only Spark {only_got}; only SQL {only_want}"


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from conftest import make_session

    import __spark_entry__ as entry

    spark, sf = make_session(), sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    sqls, bad = entry.oracle_sql(), 0
    for name in names:
        began = time.time()
        try:
            df = entry.queries()[name](spark, sf)
            out = difference(df, sqls[name], sf) if name in sqls else f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001 - the report goes on with the next query
            out = f"failed: {str(e)[:1500]}"
        bad += bool(out)
        print(f"{name:24s} {time.time() - began:6.2f}s {out or 'same'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} same")


if __name__ == "__main__":
    main()
