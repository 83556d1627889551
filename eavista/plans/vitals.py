"""Vitals report: one row per vitals encounter."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eavista import values
from eavista.functions import ages, clinical
from eavista.operators.filters import Day
from eavista.operators.obs import measures, narrow_obs, pivot_obs
from eavista.sources.clinic import Clinic


def vitals(clinic: Clinic, start: Day, end: Day) -> DataFrame:
    base = (
        clinic.encounters(values.VITALS, start, end)
        .join(clinic.live_patients(), "patient_id", "left_semi")
        .select("encounter_id", "patient_id", "visit_id", "encounter_datetime", "date_created",
                "creator", "location_id")
    )
    dictionary = clinic.dictionary
    measured = pivot_obs(
        narrow_obs(clinic["obs"], base), "encounter_id", measures(values.VITALS_MEASURES),
        dictionary,
    )
    rows = base.join(measured, "encounter_id", "left")
    rows = clinic.with_user_name(rows, "creator", "entered_by", "encounter_id")
    rows = clinic.with_location(rows, "location_id", "encounter_location", "encounter_id")
    people = clinic.people().join(clinic.identifiers(values.EMR_ID, "emr_id", base), "patient_id", "left")
    rows = rows.join(people, "patient_id", "left")
    order = [name for name, _, _ in values.VITALS_MEASURES]
    return rows.select(
        "encounter_id",
        "patient_id",
        "visit_id",
        "encounter_datetime",
        "date_created",
        "entered_by",
        "encounter_location",
        ages.full_years(F.col("birthdate"), F.col("encounter_datetime")).alias("age_at_encounter"),
        "emr_id",
        "birthdate",
        "gender",
        *order[:2],
        clinical.bmi(F.col("weight_kg"), F.col("height_cm")).alias("bmi"),
        *order[2:],
    )
