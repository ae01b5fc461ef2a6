"""Run registered queries beside their SQL and compare every value.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def compare(spark_df, con, sql: str) -> str:
    """Empty when equal, else a short description of the first difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    order = sorted(names)
    pdf = spark_df.select(*order).toArrow().to_pydict()
    left = sorted(zip(*[pdf[c] for c in order], strict=True), key=_key) if order else []
    at = [names.index(c) for c in order]
    right = sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=_key)
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}; {left[:2]} vs {right[:2]}"
    for a, b in zip(left, right, strict=True):
        for name, x, y in zip(order, a, b, strict=True):
            if type(x) is not type(y) or (x != y and not (x != x and y != y)):
                if isinstance(x, float) and isinstance(y, float):
                    if math.isclose(x, y, rel_tol=1e-12):
                        return f"NEAR {name}: {x!r} vs {y!r} in {a} vs {b}"
                return f"{name}: {x!r} vs {y!r} in {a} vs {b}"
    return ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from loanloom.catalog.lending import release
    from loanloom.session import local_session

    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.001"
    spark = local_session("compare", 8)
    con = connect(folder)
    sqls = oracle_sql()
    bad = 0
    for name, query in queries().items():
        if args[1:] and name not in args[1:]:
            continue
        t0 = time.time()
        try:
            df = query(spark, folder)
            if name not in sqls:
                print(f"{name:32s} rows-only {df.count()} {time.time() - t0:6.2f}s")
                continue
            message = compare(df, con, sqls[name])
            n = df.count() if not message else -1
        except Exception as exc:  # noqa: BLE001
            message, n = f"{type(exc).__name__}: {str(exc)[:1500]}", -1
        release()
        bad += bool(message)
        print(f"{name:32s} {'ok' if not message else 'BAD ' + message} rows={n} {time.time() - t0:6.2f}s")
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
