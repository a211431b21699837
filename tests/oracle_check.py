"""Compare a Spark result with its DuckDB oracle the way the driver does:
columns sorted by name, rows order-insensitive, doubles rounded."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normalise(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].round(6)
        # a nullable integer column comes as floats from one side
        text = [None if pd.isna(v) is True else str(int(v)) if isinstance(v, float) and v.is_integer() else str(v)
                for v in df[c]]
        df[c] = pd.Series(text, index=df.index, dtype=object).fillna("null")
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def compare(spark_df, sql: str, sf_dir: str, con=None) -> tuple[bool, str]:
    con = con or duck(sf_dir)
    got = spark_df.toPandas()
    exp = con.execute(sql).df()
    if sorted(got.columns) != sorted(exp.columns):
        return False, f"columns differ: {sorted(got.columns)} vs {sorted(exp.columns)}"
    if len(got) != len(exp):
        return False, f"row count {len(got)} vs {len(exp)}"
    a, b = normalise(got), normalise(exp)
    if not a.equals(b):
        diff = a.compare(b)
        return False, f"values differ in {len(diff)} rows:\n{diff.head(10)}"
    return True, f"{len(got)} rows equal"


def main(argv: list[str]) -> int:
    """``python tests/oracle_check.py SF_DIR [query ...]``: every (or the named)
    registered query against its DuckDB twin, one line each."""
    import os
    import sys
    import time
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry_mod
    from lshark.session import get_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    queries, sql, con = entry_mod.queries(), entry_mod.oracle_sql(), duck(sf_dir)
    failed = 0
    for name in (argv[1:] or list(queries)):
        t0 = time.time()
        if name in sql:
            ok, msg = compare(queries[name](spark, sf_dir), sql[name], sf_dir, con)
        else:
            ok, msg = True, f"{queries[name](spark, sf_dir).count()} rows, no twin"
        failed += not ok
        print(f"{name}: {'OK' if ok else 'FAIL'} {msg} ({time.time() - t0:.1f}s)", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    import sys
    raise SystemExit(main(sys.argv[1:]))
