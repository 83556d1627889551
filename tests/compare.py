"""Run registered queries and their check SQL side by side.

``python -m tests.compare [key ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry
from eavista.catalog.fixture import TABLES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "smallint": "SMALLINT",
}


def local_spark() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def check_engine(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    engine = duckdb.connect()
    for table in TABLES:
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return engine


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value if value is None else str(value)


def compare(spark, engine, key: str, sf_dir: str = SF_DIR) -> list[str]:
    """Differences between the two results; empty when they agree in columns, types and rows."""
    df = entry.queries()[key](spark, sf_dir)
    cursor = engine.execute(entry.oracle_sql()[key])
    names = [d[0] for d in cursor.description]
    kinds = [str(d[1]) for d in cursor.description]
    wanted = cursor.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} but expected {sorted(names)}"]
    spark_kinds = dict(df.dtypes)
    for name, kind in zip(names, kinds):
        if TYPES.get(spark_kinds[name], spark_kinds[name]) != kind:
            problems.append(f"type of {name}: {spark_kinds[name]} but expected {kind}")
    order = sorted(range(len(names)), key=lambda i: names[i])
    columns = [names[i] for i in order]
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    expected = sorted((tuple(_plain(r[i]) for i in order) for r in wanted), key=repr)
    if len(got) != len(expected):
        problems.append(f"{len(got)} rows but expected {len(expected)}")
    if got != expected:
        surplus = sorted(set(got) - set(expected), key=repr)[:2]
        missing = sorted(set(expected) - set(got), key=repr)[:2]
        problems.append(f"rows differ: {columns}\n    got     {surplus}\n    expected {missing}")
    if not got:
        problems.append("no rows")
    return problems


def main(keys: list[str]) -> None:
    spark, engine = local_spark(), check_engine()
    oracles = entry.oracle_sql()
    failed = 0
    for key in keys or list(entry.queries()):
        began = time.time()
        try:
            if key in oracles:
                problems = compare(spark, engine, key)
            else:
                problems = [] if entry.queries()[key](spark, SF_DIR).count() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {key} {time.time() - began:.1f}s", flush=True)
        for problem in problems:
            print(f"    {problem}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1:])
