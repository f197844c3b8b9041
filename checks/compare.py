"""Run registered queries and their SQL side by side.

    python -m checks.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), ignore_index=True, na_position="first")


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None if both hold the same rows, whatever their order."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows / {len(want)}"
    got, want = normal(got), normal(want)
    for c in got.columns:
        if got[c].dtype != want[c].dtype:
            return f"{c}: {got[c].dtype} / {want[c].dtype}"
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        if not same.all():
            i = same.idxmin()
            return f"{c}: {(~same).sum()} differ, first {got[c][i]!r} / {want[c][i]!r}"
    return None


def main() -> None:
    from checks.registry import ORACLES, QUERIES
    from checks.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = local_session(), connect(args.sf)
    failed = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            got = QUERIES[name](spark, args.sf).toPandas()
            middle = time.time()
            problem = None
            if name in ORACLES:
                problem = difference(got, con.execute(ORACLES[name]).df())
        except Exception as error:  # report and go on
            problem, middle = f"{type(error).__name__}: {str(error)[:1500]}", time.time()
            got = []
        failed += problem is not None
        print(
            f"{'FAIL' if problem else 'ok  '} {name:32} {len(got):8} rows "
            f"{middle - start:6.2f}s spark {time.time() - middle:6.2f}s sql  {problem or ''}",
            flush=True,
        )
    sys.exit(failed)


if __name__ == "__main__":
    main()
