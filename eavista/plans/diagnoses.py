"""Diagnosis report: one row per coded or free-text diagnosis observation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eavista import values
from eavista.functions import ages
from eavista.operators.filters import Day
from eavista.operators.joins import left_lookup
from eavista.operators.obs import Measure, narrow_obs, pivot_obs, staged_obs
from eavista.sources.clinic import Clinic


def diagnoses(clinic: Clinic, start: Day = None, end: Day = None) -> DataFrame:
    """Either bound of the date range may be left out."""
    dictionary = clinic.dictionary
    names = dictionary.best_names()
    encounters = (
        clinic.encounters(None, start, end)
        .join(clinic.live_patients(), "patient_id", "left_semi")
        .select("encounter_id", "patient_id", "encounter_datetime", "location_id")
    )
    codes = {"coded": values.DIAGNOSIS, "text": values.DIAGNOSIS_TEXT}
    parts = [*codes.values(), values.DIAGNOSIS_ORDER, values.DIAGNOSIS_CERTAINTY]
    # the members of an observation group belong to one encounter
    obs = staged_obs(narrow_obs(clinic["obs"], encounters, codes=parts, dictionary=dictionary), "diagnoses")
    found = dictionary.only_role(obs, "concept_id", codes, "_role").select(
        "obs_id", "obs_group_id", "encounter_id", "date_created", "creator", "value_coded",
        "value_text",
    )
    rows = found.join(encounters, "encounter_id")

    # the first order and the first certainty of each group
    siblings = pivot_obs(
        obs,
        "obs_group_id",
        [
            Measure("diagnosis_order", values.DIAGNOSIS_ORDER, "coded_name", pick="first"),
            Measure("_certainty", values.DIAGNOSIS_CERTAINTY, "coded", pick="first"),
        ],
        dictionary,
        names=names,
    ).withColumnRenamed("obs_group_id", "_group")
    rows = left_lookup(rows, siblings, "obs_group_id", "_group", "obs_id")
    shown = names.select(F.col("concept_id").alias("_concept"), F.col("name").alias("_name"))
    rows = left_lookup(rows, shown, "value_coded", "_concept", "obs_id")
    icd = dictionary.codes_of(values.ICD10).select(
        F.col("concept_id").alias("_concept"), F.col("code").alias("diagnosis_icd10_code")
    )
    rows = left_lookup(rows, icd, "value_coded", "_concept", "obs_id")

    rows = clinic.with_user_name(rows, "creator", "entered_by", "obs_id")
    rows = clinic.with_location(rows, "location_id", "encounter_location", "obs_id")
    people = clinic.people().join(clinic.identifiers(values.EMR_ID, "emr_id", encounters), "patient_id", "left")
    rows = rows.join(people, "patient_id", "left")
    confirmed = F.col("_certainty") == dictionary.concept(values.CONFIRMED)
    return rows.select(
        "patient_id",
        "encounter_id",
        "encounter_datetime",
        "date_created",
        "entered_by",
        "encounter_location",
        ages.full_years(F.col("birthdate"), F.col("encounter_datetime")).alias("age_at_encounter"),
        "emr_id",
        "birthdate",
        "gender",
        F.when(F.col("value_coded").isNotNull(), F.col("_name"))
        .otherwise(F.col("value_text"))
        .alias("diagnosis"),
        "diagnosis_icd10_code",
        "diagnosis_order",
        F.when(confirmed, dictionary.name_of(values.YES)).alias("first_time"),
    )
