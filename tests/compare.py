"""Run queries and their SQL side by side.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    """Rows with columns sorted by name, as comparable text, sorted."""
    df = df[sorted(df.columns)]
    columns = [["<null>" if pd.isna(x) else str(x) for x in df[c].astype(object)] for c in df.columns]
    return sorted(zip(*columns)) if columns else []


def integral(df: pd.DataFrame) -> pd.DataFrame:
    """Nullable integers come as floats from one engine and as integers from the other."""
    return df.convert_dtypes(convert_string=False, convert_boolean=False)


KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "double": "DOUBLE"}


def difference(spark_df, con, sql: str) -> str | None:
    """None when both agree in columns, types and values."""
    want_rel = con.sql(sql)
    want_types = dict(sorted(zip(want_rel.columns, map(str, want_rel.types))))
    got_types = {c: KINDS.get(t, t) for c, t in sorted(spark_df.dtypes)}
    got, want = normal(integral(spark_df.toPandas())), normal(integral(want_rel.df()))
    if got_types != want_types:
        return f"types {set(got_types.items()) ^ set(want_types.items())}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}; only here {list(set(got) - set(want))[:2]}, missing {list(set(want) - set(got))[:2]}"
    if got != want:
        diff = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(diff)} rows differ, first {diff[0]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from treeledger.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problem = difference(df, con, oracles[name]) if name in oracles else f"no SQL, {df.count()} rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:30s} {time.time() - start:6.2f}s  {'ok' if problem is None else problem}", flush=True)
    print("bad:", bad)
