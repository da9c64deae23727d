"""Compare every registered query with its SQL twin: ``python -m checks.verify SF_DIR [names]``."""

from __future__ import annotations

import sys
import time
from glob import glob
from os.path import basename

import duckdb
from pyspark.sql import SparkSession


def connect(sf_dir: str):
    db = duckdb.connect()
    for file in glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return db


def _sorted_rows(columns, rows):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([repr(row[i]) for i in places] for row in rows)


def compare(spark, db, sf_dir: str, query, oracle: str) -> str | None:
    """None if both results agree, else what differs."""
    df = query(spark, sf_dir)
    ours = _sorted_rows(df.columns, df.collect())
    result = db.execute(oracle)
    columns = [d[0] for d in result.description]
    theirs = _sorted_rows(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(set(df.columns) ^ set(columns))}"
    if ours != theirs:
        only = [r for r in ours if r not in theirs][:2], [r for r in theirs if r not in ours][:2]
        return f"{len(ours)} rows against {len(theirs)}; {str(only)[:600]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from .queries import ORACLES, QUERIES

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(sf_dir), 0
    for name in names or ORACLES:
        start = time.time()
        problem = compare(spark, db, sf_dir, QUERIES[name], ORACLES[name])
        failed += problem is not None
        print(f"{'ok' if problem is None else 'DIFFERS'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
