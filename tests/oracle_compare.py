"""Compare a Spark query with its DuckDB oracle on the same parquet tables.

Used by the test-suite and runnable by hand:
    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    import os
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    """Engine-neutral cell value: NULL/NaN/NA -> None, dates -> ISO text,
    numpy scalars -> Python scalars."""
    import datetime as dt
    if v is None:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time(0) else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return v.item()
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: spark={sorted(s.columns)} oracle={sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row count spark={len(s)} oracle={len(d)}"
    rs, rd = rows_of(s), rows_of(d)
    cols = sorted(s.columns)
    for a, b in zip(rs, rd):
        if a != b:
            diffs = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y]
            return False, f"first differing row: {diffs[:5]}"
    return True, f"{len(s)} rows equal"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from settlekit.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session()
    con = duck(sf)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names:
        if n not in sqls:
            print(f"{n:28s} no oracle")
            continue
        try:
            ok, msg = compare(qs[n](spark, sf), con, sqls[n])
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{n:28s} {'OK ' if ok else 'BAD'} {msg}", flush=True)
    print("mismatches:", bad)
