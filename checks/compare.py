"""Runs each query and its SQL over the same tables and compares the rows."""

from __future__ import annotations

import argparse
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES


# The SQL engine's type names for Spark's.
TYPES = {"bigint": "bigint", "integer": "int", "date": "date", "varchar": "string"}


def expected_rows(sf_dir: str, sql: str) -> tuple[dict[str, str], list[tuple]]:
    """Column types and rows of a query's SQL."""
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = connection.execute(sql)
    types = {name: str(kind).lower() for name, kind, *_ in result.description}
    return {name: TYPES.get(kind, kind) for name, kind in types.items()}, result.fetchall()


def differences(spark: SparkSession, sf_dir: str, name: str) -> list[str]:
    """What differs between a query and its SQL, nothing if they agree."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    actual = Counter(tuple(row) for row in df.select(columns).collect())
    types, rows = expected_rows(sf_dir, ORACLE_SQL[name])
    if types != dict(df.dtypes):
        return [f"{dict(df.dtypes)} against {types}"]
    order = [list(types).index(column) for column in columns]
    expected = Counter(tuple(row[i] for i in order) for row in rows)
    found = [f"too many: {row}" for row in list((actual - expected).elements())[:3]]
    found += [f"missing: {row}" for row in list((expected - actual).elements())[:3]]
    return found if actual else [*found, "no rows at all"]


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("sf_dir")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in args.names or QUERIES:
        started = time.time()
        found = differences(spark, args.sf_dir, name)
        bad += bool(found)
        print(f"{name:28s} {'ok' if not found else found} {time.time() - started:.1f}s", flush=True)
    raise SystemExit(bad)


if __name__ == "__main__":
    main()
