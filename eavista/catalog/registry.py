"""Registered checks: a Spark query and, where SQL can express it, the same in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eavista.catalog.fixture import Fixture, check_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The current name and address of each person, for check SQL.
NAME_SQL = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY preferred DESC,
  date_created DESC, person_name_id DESC) AS place FROM fx_person_name WHERE voided = 0) x WHERE place = 1"""
ADDRESS_SQL = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY preferred DESC,
  date_created DESC, person_address_id DESC) AS place FROM fx_person_address WHERE voided = 0) x WHERE place = 1"""

#: Inside the range of the test tables: rows lie before, after and on both end days.
START, END = "1996-03-15", "1999-06-20"


def _comparable(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that both engines' results print alike."""
    dated = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, dated)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def check(key: str, sql: str | None = None):
    """Register ``build(fx) -> DataFrame`` under ``key``, with its check SQL."""

    def register(build: Callable[[Fixture], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _comparable(build(Fixture.of(spark, sf_dir)))

        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        run.__doc__ = build.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = check_sql(sql)
        return build

    return register
