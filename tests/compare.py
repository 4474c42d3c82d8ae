"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

``python tests/compare.py [name-prefix …]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402

FOLDER = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str = FOLDER):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _key(row):
    return tuple((v is None, f"{v:.9g}" if isinstance(v, float) else str(v)) for v in row)


def same(left: list[tuple], right: list[tuple]) -> str | None:
    """None when both are equal as bags, else what differs; doubles may differ in the last digits."""
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}"
    for a, b in zip(sorted(left, key=_key), sorted(right, key=_key)):
        for x, y in zip(a, b):
            equal = x == y
            if isinstance(x, float) and isinstance(y, float):
                equal = math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)
            if not equal:
                return f"{a} vs {b}"
    return None


def check(spark, con, name: str, folder: str = FOLDER) -> tuple[str | None, int, float, bool]:
    """(difference, rows, seconds, exact) of one query; ``exact`` is bitwise equality of the values."""
    started = time.time()
    df = contract.queries()[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    seconds = time.time() - started
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None, len(rows), seconds, True
    cursor = con.execute(sql)
    order = [d[0] for d in cursor.description]
    if sorted(order) != sorted(df.columns):
        return f"columns {df.columns} vs {order}", len(rows), seconds, False
    places = [order.index(c) for c in df.columns]
    wanted = [tuple(r[i] for i in places) for r in cursor.fetchall()]
    difference = same(rows, wanted)
    exact = difference is None and sorted(map(repr, rows)) == sorted(map(repr, wanted))
    return difference, len(rows), seconds, exact


def main(prefixes: list[str]) -> int:
    from benchloom.session import local_session

    spark, con, bad = local_session(), duck(), 0
    for name in contract.queries():
        if prefixes and not name.startswith(tuple(prefixes)):
            continue
        try:
            difference, rows, seconds, exact = check(spark, con, name)
        except Exception as exc:
            difference, rows, seconds, exact = f"{type(exc).__name__}: {str(exc)[:1500]}", -1, 0.0, False
        bad += difference is not None
        mark = "ok" if difference is None else "DIFF"
        kind = "sql" if name in contract.oracle_sql() else "rows"
        print(f"{mark:5}{name:28}{kind:5}rows={rows:<7}{seconds:6.2f}s{'' if exact else ' inexact'} {difference or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
