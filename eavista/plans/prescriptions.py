"""Controlled prescriptions: consults with a controlled drug, and their medication lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eavista import values
from eavista.functions import ages
from eavista.operators.filters import Day, active
from eavista.operators.joins import left_lookup
from eavista.operators.lookups import full_name
from eavista.operators.obs import (
    Measure, medication_lines, narrow_obs, ordered_list, pivot_obs, staged_obs,
)
from eavista.sources.clinic import Clinic
from eavista.sources.dictionaries import set_closure


def controlled_drugs(clinic: Clinic, nested_sets: bool = False) -> DataFrame:
    """Live drugs whose concept is a direct member of the controlled set (or a nested one)."""
    dictionary = clinic.dictionary
    edges = clinic["concept_set"].select("concept_set", "concept_id")
    root = dictionary.concept(values.CONTROLLED_SET)
    if nested_sets:
        members = set_closure(edges, "concept_set", "concept_id", root).select(
            F.col("member").alias("concept_id")
        )
    else:
        members = edges.filter(F.col("concept_set") == root).select("concept_id")
    return clinic.active("drug").join(members, "concept_id", "left_semi")


def controlled_consults(
    clinic: Clinic,
    start: Day,
    end: Day,
    patient_id: int | None,
    nested_sets: bool,
    codes: list[str],
) -> tuple[DataFrame, DataFrame]:
    """Consults that prescribe at least one controlled drug, and their observations of ``codes``."""
    dictionary = clinic.dictionary
    consults = clinic.encounters(values.CONSULT, start, end, patient_id).select(
        "encounter_id", "patient_id", "encounter_datetime"
    )
    codes = [values.MEDICATION, *codes]
    obs = staged_obs(narrow_obs(clinic["obs"], consults, codes=codes, dictionary=dictionary), "prescriptions")
    prescribed = dictionary.only_role(
        obs, "concept_id", {"medication": values.MEDICATION}, "_role"
    ).select("encounter_id", F.col("value_drug").alias("drug_id"))
    qualifying = prescribed.join(
        controlled_drugs(clinic, nested_sets).select("drug_id"), "drug_id", "left_semi"
    )
    consults = consults.join(qualifying, "encounter_id", "left_semi")
    return consults, obs.join(qualifying, "encounter_id", "left_semi")


def all_diagnoses(clinic: Clinic, obs: DataFrame) -> DataFrame:
    """(encounter_id, obs_id, diagnosis, sort_order): coded and free-text, primary ones first."""
    dictionary = clinic.dictionary
    codes = {"coded": values.DIAGNOSIS, "text": values.DIAGNOSIS_TEXT_NUMBER}
    found = dictionary.only_role(obs, "concept_id", codes, "_role")
    coded = dictionary.with_name(found.filter("_role = 'coded'"), "value_coded", "name", "obs_id")
    columns = ["encounter_id", "obs_id", "obs_group_id"]
    rows = coded.select(*columns, F.col("name").alias("diagnosis")).unionByName(
        found.filter("_role = 'text'").select(*columns, F.col("value_text").alias("diagnosis"))
    )
    primary = pivot_obs(
        obs.filter("obs_group_id IS NOT NULL"), "obs_group_id",
        [Measure("_primary", values.DIAGNOSIS_ORDER, "coded", answer=values.PRIMARY)], dictionary,
    ).withColumnRenamed("obs_group_id", "_group")
    rows = left_lookup(rows, primary, "obs_group_id", "_group", "obs_id")
    return rows.select(
        "encounter_id", "obs_id", "diagnosis",
        F.when(F.col("_primary").isNotNull(), 0).otherwise(1).alias("sort_order"),
    )


def allergy_lists(clinic: Clinic, include_voided: bool = False, patients: DataFrame | None = None) -> DataFrame:
    """(patient_id, allergies): each displayed allergy once, in alphabetical order."""
    dictionary = clinic.dictionary
    rows = clinic["allergy"] if include_voided else active(clinic["allergy"])
    if patients is not None:
        rows = rows.join(patients.select("patient_id").distinct(), "patient_id", "left_semi")
    names = dictionary.best_names().select(F.col("concept_id").alias("_concept"), "name")
    rows = left_lookup(rows, names, "coded_allergen", "_concept", "patient_id")
    other = F.col("coded_allergen") == dictionary.concept(values.OTHER)
    shown = F.when(other, F.col("non_coded_allergen")).otherwise(F.col("name"))
    return (
        rows.select("patient_id", shown.alias("allergy"))
        .distinct()
        .groupBy("patient_id")
        .agg(ordered_list("allergy", ", ", "allergy").alias("allergies"))
    )


def controlled_encounters(
    clinic: Clinic,
    start: Day = None,
    end: Day = None,
    patient_id: int | None = None,
    nested_sets: bool = False,
    include_voided: bool = False,
) -> DataFrame:
    codes = [values.DIAGNOSIS, values.DIAGNOSIS_TEXT_NUMBER, values.DIAGNOSIS_ORDER]
    consults, obs = controlled_consults(clinic, start, end, patient_id, nested_sets, codes)
    lists = all_diagnoses(clinic, obs).groupBy("encounter_id").agg(
        ordered_list("diagnosis", ", ", "sort_order", "obs_id").alias("diagnoses")
    )
    rows = consults.join(lists, "encounter_id", "left").join(
        clinic.providers("prescriber", consults), "encounter_id", "left"
    )
    for table in (clinic.people(), clinic.names(consults), allergy_lists(clinic, include_voided, consults)):
        rows = rows.join(table, "patient_id", "left")
    date = F.to_date("encounter_datetime")
    return rows.select(
        "encounter_id",
        "patient_id",
        date.alias("encounter_date"),
        "prescriber",
        full_name().alias("patient_name"),
        "birthdate",
        ages.full_years(F.col("birthdate"), date).alias("age"),
        "diagnoses",
        "allergies",
        F.lit(True).alias("has_qualifying_prescription"),
    )


def controlled_meds(
    clinic: Clinic,
    start: Day = None,
    end: Day = None,
    patient_id: int | None = None,
    nested_sets: bool = False,
) -> DataFrame:
    """All medication lines of those consults, also of drugs that are not controlled."""
    codes = [values.MEDICATION_GROUP, *[m[1] for m in values.MEDICATION_MEASURES]]
    _, obs = controlled_consults(clinic, start, end, patient_id, nested_sets, codes)
    lines = medication_lines(obs, clinic.dictionary, clinic["drug"])
    return lines.select(
        "encounter_id", "obs_group_id", *[m[0] for m in values.MEDICATION_MEASURES]
    )
