"""Run registered queries in Spark and DuckDB and compare rows and values."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    return con


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(str(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> tuple[bool, str]:
    """Whether both engines give the same rows, and a line that says so."""
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    spent = time.time() - start
    if name not in ORACLES:
        return True, f"{name}: {len(rows)} rows, no SQL, {spent:.1f}s"
    start = time.time()
    result = con.sql(ORACLES[name])
    mine, theirs = rows_of(df.columns, rows), rows_of(result.columns, result.fetchall())
    same = sorted(df.columns) == sorted(result.columns) and mine == theirs
    line = f"{name}: {'same' if same else 'DIFFERENT'} {mine.total()} rows, {spent:.1f}s / {time.time() - start:.1f}s"
    if not same:
        line += f"\n  {sorted(df.columns)}\n  {sorted(result.columns)} {theirs.total()} rows"
        line += f"\n  only Spark {list((mine - theirs).items())[:2]}"
        line += f"\n  only SQL   {list((theirs - mine).items())[:2]}"
    return same, line


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or list(QUERIES):
        same, line = compare(spark, con, sf_dir, name)
        failed += not same
        print(line[:3000], flush=True)
    print(f"{failed} different")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
