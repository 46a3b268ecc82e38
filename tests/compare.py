"""Run registered queries next to their SQL. `python tests/compare.py [folder] [name ...]`"""

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return ("f", "nan") if math.isnan(v) else ("f", f"{v:.9g}")
    if v is None:
        return ("", "")
    return (type(v).__name__, str(v))


def sorted_rows(names: list[str], rows) -> tuple[list[str], list]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def differences(spark, con, name: str, folder: str) -> str | None:
    """None if the query and its SQL agree; else the first difference."""
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, folder)
    got_names, got = sorted_rows(df.columns, df.collect())
    sql = oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    want_names, want = sorted_rows([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return "\n" + "\n".join(f"  {n}: {a} != {b}" for n, a, b in zip(got_names, g, w) if a != b)
    return None if got else "no rows"


if __name__ == "__main__":
    from tests.conftest import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from __spark_entry__ import oracle_sql, queries

    spark, con = session(), duck(folder)
    for name in sys.argv[2:] or queries():
        t = time.time()
        try:
            diff = differences(spark, con, name, folder)
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        kind = "" if name in oracle_sql() else " (rows only)"
        print(f"{'FAIL' if diff else 'ok'} {name}{kind} {time.time() - t:.1f}s {diff or ''}", flush=True)
