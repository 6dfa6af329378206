"""Run registered queries next to their SQL check in DuckDB and compare values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from plumbline.plans import all_oracles, all_queries  # noqa: E402
from plumbline.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 4) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    found = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(found, key=repr)


def compare(spark, con, name: str, sf_dir: str):
    """(problem or None, number of rows, seconds)."""
    start = time.time()
    df = all_queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - start
    sql = all_oracles().get(name)
    if sql is None:
        return None, len(got[1]), seconds
    cursor = con.execute(sql)
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", len(got[1]), seconds
    if got[1] != want[1]:
        only_got = [r for r in got[1] if r not in set(want[1])][:3]
        only_want = [r for r in want[1] if r not in set(got[1])][:3]
        return f"{len(got[1])} rows != {len(want[1])} rows\n  spark {only_got}\n  duck  {only_want}", len(got[1]), seconds
    return None, len(got[1]), seconds


def main() -> None:
    from plumbline.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = local_session(8), duck(sf_dir)
    names = [n for n in all_queries() if not sys.argv[1:] or any(a in n for a in sys.argv[1:])]
    bad = 0
    for name in names:
        try:
            problem, rows, seconds = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem, rows, seconds = f"{type(error).__name__}: {str(error)[:600]}", -1, 0.0
        checked = "checked" if name in all_oracles() else "no sql"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name:36} {rows:8} rows {seconds:6.2f}s {checked} {problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} failing")


if __name__ == "__main__":
    main()
