"""Compare every registered entry with its SQL in DuckDB.

``python tests/compare.py <data folder> [spark.setting=value ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
TABLES += ["documents", "benchmark", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else repr(v)
        return repr(v)

    return sorted(tuple(value(r[i]) for i in order) for r in rows)


def difference(df, con, sql) -> str | None:
    ours = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir: str, *settings: str) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for setting in settings:
        spark.conf.set(*setting.split("=", 1))
    con, sql, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, make in entry.queries().items():
        if name not in sql:
            continue
        start = time.time()
        found = difference(make(spark, sf_dir), con, sql[name])
        bad += found is not None
        print(f"{name:28} {time.time() - start:6.2f}s  {found or 'equal'}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
