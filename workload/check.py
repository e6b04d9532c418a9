"""Compare every registered query with its SQL: ``python -m workload.check [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession

from workload.oracles import ORACLES
from workload.queries import QUERIES


def rows_of(result: pa.Table) -> list[str]:
    """Rows with columns by name, in an order that does not depend on the engine."""
    rows = result.select(sorted(result.column_names)).to_pylist()
    return sorted(repr([value.replace(tzinfo=None) if hasattr(value, "tzinfo") else value for value in row.values()]) for row in rows)


def compare(spark: SparkSession, sf_dir: str, name: str) -> tuple[bool, int, int]:
    """Whether a query and its SQL agree, and the rows of each."""
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{path}')")
    wanted = connection.sql(ORACLES[name]).to_arrow_table()
    got = QUERIES[name](spark, sf_dir).toArrow()
    same = sorted(got.column_names) == sorted(wanted.column_names) and rows_of(got) == rows_of(wanted)
    return same, got.num_rows, wanted.num_rows


def session(cores: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    bad = []
    for name in sys.argv[2:] or QUERIES:
        start = time.monotonic()
        same, got, wanted = compare(spark, sf_dir, name)
        print(f"{'ok ' if same else 'BAD'} {name}: {got} / {wanted} rows, {time.monotonic() - start:.1f} s", flush=True)
        bad += [] if same else [name]
    sys.exit(f"different: {bad}" if bad else 0)
