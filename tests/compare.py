"""Run queries in Spark and their SQL in DuckDB over the same tables and compare all rows.

    python tests/compare.py FOLDER [NAME ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    base = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        base.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return base


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in a fixed order, every missing value alike."""
    frame = frame[sorted(frame.columns)]
    text = frame.apply(lambda column: column.map(lambda v: "∅" if pd.isna(v) else _text(v)))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def _text(value) -> str:
    if isinstance(value, float):
        return repr(value + 0.0)
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)


def differences(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} / {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}"
    left, right = normal(spark_rows), normal(sql_rows)
    unlike = left.ne(right)
    if unlike.any(axis=None):
        columns = list(unlike.columns[unlike.any()])
        at = unlike.any(axis=1).idxmax()
        return f"{int(unlike.any(axis=1).sum())} rows, columns {columns}; {left.loc[at, columns].to_dict()} / {right.loc[at, columns].to_dict()}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as driver

    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, checks, base = driver.queries(), driver.oracle_sql(), connect(folder)
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            rows = queries[name](spark, folder).toPandas()
            took = time.time() - start
            if name not in checks:
                print(f"ROWS {name} {len(rows)} {took:.2f}s", flush=True)
                continue
            found = differences(rows, base.execute(checks[name]).df())
            oracle = time.time() - start - took
            print(f"{'FAIL' if found else 'OK'} {name} {len(rows)} {took:.2f}s sql {oracle:.2f}s {found or ''}", flush=True)
            failed += bool(found)
        except Exception as error:  # keep going: the other queries still tell something
            failed += 1
            print(f"FAIL {name} {type(error).__name__}: {str(error)[:700]}", flush=True)
    print("failed", failed)


if __name__ == "__main__":
    main()
