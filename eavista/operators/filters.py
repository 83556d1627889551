"""Row filters, written so that they reach the file scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

Day = dt.date | str | None


def _day(value: Day) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def active(df: DataFrame) -> DataFrame:
    """Rows that are neither voided nor retired."""
    flag = "voided" if "voided" in df.columns else "retired" if "retired" in df.columns else None
    return df if flag is None else df.filter(F.col(flag) == 0)


def in_date_range(df: DataFrame, column: str, start: Day = None, end: Day = None) -> DataFrame:
    """Calendar days from ``start`` to ``end``, both included; an open side has no condition.

    The column stays bare (no ``date(column)``), so the bounds become pushed filters.
    """
    kind = df.schema[column].dataType.simpleString()
    bound = lambda day: F.lit(f"{day} 00:00:00").cast(kind)
    if start is not None:
        df = df.filter(F.col(column) >= bound(_day(start)))
    if end is not None:
        df = df.filter(F.col(column) < bound(_day(end) + dt.timedelta(days=1)))
    return df


def patient_or_range(
    df: DataFrame, column: str, start: Day = None, end: Day = None, patient_id: int | None = None
) -> DataFrame:
    """One patient's rows if a patient is named, otherwise the rows of the date range."""
    if patient_id is not None:
        return df.filter(F.col("patient_id") == patient_id)
    return in_date_range(df, column, start, end)


def overlay(*updates: tuple[Column, Column], base: Column | None = None) -> Column:
    """The value after updates applied in order: the last update whose condition holds wins."""
    result: Column | None = None
    for condition, value in reversed(updates):
        result = F.when(condition, value) if result is None else result.when(condition, value)
    if result is None:
        raise ValueError("no update given")
    return result if base is None else result.otherwise(base)
