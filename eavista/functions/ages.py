"""Dates and ages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from eavista import values


def full_years(birth: Column, on: Column) -> Column:
    """Completed years; someone born on 29 February turns older on 1 March."""
    return F.timestamp_diff("YEAR", birth.cast("date"), on.cast("date")).cast("int")


def full_months(birth: Column, on: Column) -> Column:
    return F.timestamp_diff("MONTH", birth.cast("date"), on.cast("date")).cast("int")


def months_after_year(birth: Column, on: Column) -> Column:
    """Completed months since the last birthday."""
    return full_months(birth, on) % 12


def days_after_month(birth: Column, on: Column) -> Column:
    """Days since the last completed month of age."""
    return F.datediff(on.cast("date"), F.add_months(birth.cast("date"), full_months(birth, on)))


def decimal_years(birth: Column, on: Column) -> Column:
    """Age in years with one decimal place, on a year of 365.25 days."""
    return F.round(F.datediff(on.cast("date"), birth.cast("date")) / F.lit(365.25), 1).cast("double")


def date_and_time_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def gestational_age(
    last_period: Column, on: Column, weeks_word: str = "semanas"
) -> dict[str, Column]:
    """Days, weeks and remaining days of pregnancy, the weeks text and the due date."""
    days = F.datediff(on.cast("date"), last_period.cast("date"))
    weeks = F.floor(days / 7).cast("int")
    rest = days % 7
    return {
        "gestational_days": days,
        "gestational_weeks": weeks,
        "remainder_days": rest,
        "gestational_text": F.concat(
            weeks.cast("string"),
            F.lit(" "),
            F.when(rest != 0, F.concat(rest.cast("string"), F.lit("/7 "))).otherwise(F.lit(" ")),
            F.lit(weeks_word),
        ),
        "due_date": F.date_add(last_period.cast("date"), values.GESTATION_DAYS),
    }
