"""Compares every registered query with its SQL on DuckDB, order-insensitively.

Usage: python tests/oracle.py SF_DIR [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pandas as pd  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if frame[c].dtype.kind in "iuf":
            frame[c] = frame[c].astype("float64").round(6)
    frame = frame.astype(object).where(frame.notna(), None)
    keys = frame.map(str)
    order = keys.sort_values(list(keys.columns)).index
    return frame.loc[order].reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    a, b = canonical(spark_frame), canonical(sql_frame)
    unequal = (a != b) & ~(a.isna() & b.isna())
    if unequal.to_numpy().any():
        at = unequal.any(axis=1).idxmax()
        return f"{int(unequal.any(axis=1).sum())} rows, first {a.loc[at].to_dict()} / {b.loc[at].to_dict()}"
    return None


def types(df, con, sql) -> str:
    names = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    there = {r[0]: names.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return ", ".join(f"{n}:{t}/{there.get(n)}" for n, t in df.dtypes if there.get(n) != t)


if __name__ == "__main__":
    import __spark_entry__ as entry
    from basketry.session import local_session

    spark = local_session()
    con = connect(sys.argv[1])
    checks, chosen = entry.oracle_sql(), sys.argv[2:]
    for name, run in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        df = run(spark, sys.argv[1])
        got = df.toPandas()
        took = time.time() - start
        if name not in checks:
            print(f"{name:28} rows only {len(got):8} {took:6.1f}s", flush=True)
            continue
        try:
            verdict = difference(got, con.execute(checks[name]).df()) or "ok"
            verdict += " " + types(df, con, checks[name])
        except Exception as error:  # shown, and the next query goes on
            verdict = f"SQL {str(error)[:300]}"
        print(f"{name:28} {verdict} {len(got):8} {took:6.1f}s", flush=True)
