"""Run registered queries against their SQL: ``python tests/check_oracle.py DIR [key ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted texts, columns by name; doubles keep all their digits."""
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple("NULL" if v is None or v is pd.NA or v is pd.NaT or v != v else repr(v) for v in row)
        for row in frame.astype(object).itertuples(index=False, name=None)
    ]
    return sorted(rows)


def kinds(frame: pd.DataFrame) -> dict[str, str]:
    return {c: str(frame[c].dtype) for c in sorted(frame.columns)}


def difference(got: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """What differs between two results, or None."""
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns {sorted(got.columns)} != {sorted(expected.columns)}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    # Whole numbers with nulls come as doubles from one side and as nullable integers from the other.
    whole = {c: "Int64" for c in got.columns if "Int64" in (str(expected[c].dtype), str(got[c].dtype))}
    have, want = canonical(got.astype(whole)), canonical(expected.astype(whole))
    if have != want:
        only = [(h, w) for h, w in zip(have, want) if h != w][:2]
        return f"values differ: {only}"
    return None


def main() -> int:
    from adflow.plans.catalog import ORACLES, QUERIES
    from adflow.session import local_session, remove_written

    sf_dir, keys = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    bad = 0
    for key in keys:
        began = time.time()
        try:
            got = QUERIES[key](spark, sf_dir).toPandas()
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL {key}: {str(error)[:1500]}", flush=True)
            continue
        took = time.time() - began
        if key not in ORACLES:
            print(f"rows {key} {len(got)} {took:.1f}s", flush=True)
            continue
        try:
            expected = con.execute(ORACLES[key]).df()
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL {key} sql: {str(error)[:800]}", flush=True)
            continue
        problem = difference(got, expected)
        if problem is None and kinds(got) != kinds(expected):
            other = kinds(expected)
            print(f"     {key} kinds {[(c, k, other[c]) for c, k in kinds(got).items() if other[c] != k]}")
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {key} {len(got)} {took:.1f}s {problem or ''}"[:1500], flush=True)
    print("bad:", bad)
    remove_written(spark)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
