"""Compare the registered queries with their SQL: check_queries.py SF_DIR [NAME...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from streamwatch.registry.oracles import ORACLES  # noqa: E402
from streamwatch.registry.queries import QUERIES  # noqa: E402
from streamwatch.session import build_session  # noqa: E402

TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean",
    "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
}


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[name]):
            df[name] = df[name].astype("datetime64[us]")
        elif df[name].dtype == object or str(df[name].dtype) in ("str", "string"):
            df[name] = df[name].astype(object).where(df[name].notna(), None)
    return df.sort_values(list(df.columns), ignore_index=True)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """Why two results differ, or ``None``; values must be equal to the last digit shown."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    got, want = canonical(got), canonical(want)
    for name in got.columns:
        same = (got[name] == want[name]) | (got[name].isna() & want[name].isna())
        if not same.all():
            row = int((~same).idxmax())
            return f"{name}: {(~same).sum()} values, first {got[name][row]!r} against {want[name][row]!r}"
    return None


def types_differ(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    relation = con.sql(sql)
    want = {n: TYPES[str(kind)] for n, kind in zip(relation.columns, relation.types)}
    got = {f.name: f.dataType.simpleString() for f in result.schema}
    wrong = {n: (got[n], want[n]) for n in got if got[n] != want[n]}
    return f"types {wrong}" if wrong else None


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            result = QUERIES[name](spark, sf_dir)
            got = result.toPandas()
            took = time.time() - started
            problem = None
            if name in ORACLES:
                want = con.execute(ORACLES[name]).df()
                problem = difference(got, want) or types_differ(result, con, ORACLES[name])
            state = "FAIL " + problem if problem else ("ok" if name in ORACLES else "ok, rows only")
        except Exception as error:
            took, got, state = time.time() - started, [], f"ERROR {str(error)[:3000]}"
            problem = state
        failed += problem is not None
        print(f"{name:24} {len(got):7} rows {took:6.2f} s  {state}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
