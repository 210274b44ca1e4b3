"""Run check queries on Spark and their oracles on DuckDB and compare the rows."""

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def differences(
    spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str
) -> str | None:
    """None when both engines give the same rows, else a short description."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    relation = connection.sql(ORACLES[name])
    if sorted(relation.columns) != columns:
        return f"columns {columns} != {sorted(relation.columns)}"
    got = Counter(tuple(r) for r in df.select(*columns).collect())
    want = Counter(relation.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    if got == want:
        return None
    extra, lacking = list((got - want).items())[:2], list((want - got).items())[:2]
    return (
        f"{got.total()} rows against {want.total()}; only Spark {extra}; only oracle {lacking}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    from quotebridge.session import local_session

    spark = local_session()
    connection = oracle_connection(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = differences(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s", problem or "")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
