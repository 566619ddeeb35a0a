"""Run registered queries next to their SQL and compare the results.

    python tools/compare.py [--dir /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import pathlib
import sys
import time

import duckdb
import pandas as pd

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from granary import local_session  # noqa: E402
from workload import oracle  # noqa: E402
from workload.queries import registered  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, every value as text, rows in a fixed order."""
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        values = frame[c]
        if pd.api.types.is_float_dtype(values):
            frame[c] = [("" if v != v else repr(round(float(v) + 0.0, 6))) for v in values]
        else:
            frame[c] = ["" if pd.isna(v) else str(v) for v in values]
    return frame.sort_values(list(frame.columns), kind="stable").reset_index(drop=True)


def rows_of(con: duckdb.DuckDBPyConnection, sql: str) -> pd.DataFrame:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return pd.DataFrame(cursor.fetchall(), columns=names)


def spark_rows(df) -> pd.DataFrame:
    return pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns)


def difference(left: pd.DataFrame, right: pd.DataFrame) -> str | None:
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} / {sorted(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    left, right = normal(left), normal(right)
    if left.equals(right):
        return None
    differing = (left != right).any(axis=1)
    first = differing.idxmax()
    cells = {
        c: (left.at[first, c], right.at[first, c])
        for c in left.columns
        if left.at[first, c] != right.at[first, c]
    }
    return f"{int(differing.sum())} of {len(left)} rows differ, first: {cells}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.dir)
    queries, sql = registered(), oracle.statements()
    print("no SQL:", sorted(set(queries) - set(sql)), " no query:", sorted(set(sql) - set(queries)))
    failed = []
    for name in args.names or queries:
        begin = time.time()
        try:
            got = spark_rows(queries[name](spark, args.dir))
            middle = time.time()
            problem = difference(got, rows_of(con, sql[name])) if name in sql else None
            note = f"{len(got):>8} rows {middle - begin:6.2f}s spark {time.time() - middle:6.2f}s sql"
        except Exception as error:
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        print(("FAIL " if problem else "ok   ") + f"{name:<36}{note}" + (f"\n     {problem}" if problem else ""))
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
