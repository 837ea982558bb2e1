"""Run queries in Spark and in DuckDB over the same tables and compare the rows.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import SQL
from checks.registry import QUERIES


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("feedmerge")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tables(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(sf).glob("*.parquet")):
        source = f"{file}/*.parquet" if file.is_dir() else str(file)
        db.execute(f"create view {file.stem} as select * from read_parquet('{source}')")
    return db


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns in name order, rows in a repeatable order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(found, key=repr)


def expected(db: duckdb.DuckDBPyConnection, sql: str):
    result = db.execute(sql)
    return rows_of([c[0] for c in result.description], result.fetchall())


def actual(spark: SparkSession, name: str, sf: str):
    df = QUERIES[name](spark, sf)
    return rows_of(df.columns, df.collect())


def main(sf: str, names: list[str]) -> int:
    spark, db, failed = session(), tables(sf), 0
    for name in names or list(QUERIES):
        started = time.time()
        try:
            got = actual(spark, name, sf)
        except Exception as error:
            print(f"{name:30} ERROR {str(error)[:600]}")
            failed += 1
            continue
        took = time.time() - started
        if name not in SQL:
            print(f"{name:30} rows only: {len(got[1])} in {took:.2f}s")
            continue
        try:
            want = expected(db, SQL[name])
        except Exception as error:
            print(f"{name:30} ORACLE ERROR {str(error)[:600]}")
            failed += 1
            continue
        same = got == want
        failed += not same
        print(f"{name:30} {'ok' if same else 'DIFFERS'} {len(got[1])}/{len(want[1])} rows in {took:.2f}s")
        if not same:
            print("   ", got[0], want[0]) if got[0] != want[0] else None
            bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b][:2]
            print("   ", *bad, sep="\n    ")
    print("missing oracle:", sorted(set(QUERIES) - set(SQL)), "missing query:", sorted(set(SQL) - set(QUERIES)))
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
