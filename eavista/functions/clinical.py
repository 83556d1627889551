"""Derived clinical values and row rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from eavista import values
from eavista.functions.text import fixed_map, number_text


def bmi(weight_kg: Column, height_cm: Column) -> Column:
    """Body mass index with one decimal; null without both measures or with zero height.

    A tie goes to the even digit, as the C library rounds doubles for the database.
    """
    metres = F.nullif(height_cm, F.lit(0.0)) / 100
    return F.rint(weight_kg / (metres * metres) * 10) / 10


def blood_pressure_text(systolic: str, diastolic: str) -> Column:
    """``120/80``; empty without a systolic value, null when only the diastolic is missing."""
    return F.when(F.col(systolic).isNull(), F.lit("")).otherwise(
        F.concat(number_text(systolic), F.lit("/"), number_text(diastolic))
    )


def percent_reduction(baseline: Column, current: Column) -> Column:
    """Whole-number percent fall from the baseline; halves round up, as in a browser.

    Both figures are cut to whole numbers first. Null on a zero baseline.
    """
    base = F.nullif(baseline.cast("bigint"), F.lit(0).cast("bigint"))
    return F.floor((base - current.cast("bigint")) / base * 100 + F.lit(0.5)).cast("bigint")


def bmi_if_old_enough(age: Column, weight_kg: Column, height_cm: Column) -> Column:
    return F.when(age > values.BMI_MIN_AGE, bmi(weight_kg, height_cm))


def head_circumference_if_young(age: Column, measure: Column) -> Column:
    return F.when(age < values.HEAD_CIRCUMFERENCE_MAX_AGE, measure)


def medication_violations(
    drug: Column,
    dose: Column,
    dose_unit: Column,
    frequency: Column,
    duration: Column,
    duration_unit: Column,
    instructions: Column,
) -> dict[str, Column]:
    """The five checks of a medication line, each true when the line breaks it."""
    details = [dose, dose_unit, frequency, duration, duration_unit, instructions]
    any_detail = F.coalesce(*[c.cast("string") for c in details]).isNotNull()
    return {
        "details_without_drug": drug.isNull() & any_detail,
        "dose_without_unit": dose.isNotNull() & dose_unit.isNull(),
        "unit_without_dose": dose.isNull() & dose_unit.isNotNull(),
        "duration_without_unit": duration.isNotNull() & duration_unit.isNull(),
        "unit_without_duration": duration.isNull() & duration_unit.isNotNull(),
    }


def exit_without_outcome(exits: dict[str, tuple[Column, Column]]) -> Column:
    """Names of the programs marked as left for which no outcome was recorded."""
    return F.array_compact(
        F.array(
            *[
                F.when(F.coalesce(left, F.lit(False)) & outcome.isNull(), F.lit(program))
                for program, (left, outcome) in exits.items()
            ]
        )
    )


def answer_score(answer: Column) -> Column:
    """0 to 3 for a questionnaire answer, null for a text that is not an answer."""
    return F.try_element_at(fixed_map(values.ANSWER_SCORES), answer)
