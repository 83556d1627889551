"""Front sheet: one row per patient, from the latest registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eavista import values
from eavista.functions import text
from eavista.operators.filters import Day
from eavista.operators.joins import left_lookup
from eavista.operators.latest import latest_per_key, newest
from eavista.operators.obs import Measure, narrow_obs, pivot_obs, staged_obs
from eavista.sources.clinic import Clinic


def latest_registration(clinic: Clinic, patients: DataFrame | None = None) -> DataFrame:
    """(patient_id, registration_encounter_id, registration_datetime, registration_location_id).

    Of all patients, or of those in ``patients``, whose registrations alone are ranked then.
    """
    rows = clinic.encounters(values.REGISTRATION)
    if patients is not None:
        rows = rows.join(patients.select("patient_id").distinct(), "patient_id", "left_semi")
    return latest_per_key(rows, "patient_id", *newest("encounter_datetime", "encounter_id")).select(
        "patient_id",
        F.col("encounter_id").alias("registration_encounter_id"),
        F.col("encounter_datetime").alias("registration_datetime"),
        F.col("location_id").alias("registration_location_id"),
    )


def front_sheet(
    clinic: Clinic,
    start: Day = None,
    end: Day = None,
    patient_id: int | None = None,
    include_voided: bool = False,
) -> DataFrame:
    """The named patient, or every patient with a consult in the date range."""
    dictionary = clinic.dictionary
    patients = (
        clinic.encounters(values.CONSULT, start, end, patient_id).select("patient_id").distinct()
    )
    registered = latest_registration(clinic, patients)
    rows = patients.join(registered, "patient_id", "left")

    # the members of an observation group belong to one encounter, so one narrowed copy serves all
    keys = registered.select(F.col("registration_encounter_id").alias("encounter_id"))
    codes = [values.INSURANCE, values.POLICY_NUMBER, values.CIVIL_STATUS, values.OCCUPATION]
    obs = staged_obs(narrow_obs(clinic["obs"], keys, codes=codes, dictionary=dictionary), "front-sheet")
    insurance = obs
    if include_voided:
        insurance = clinic["obs"].join(keys, "encounter_id", "left_semi")
    insured = dictionary.only_role(
        insurance, "concept_id", {"insurance": values.INSURANCE}, "_role"
    ).filter(F.col("value_coded") == dictionary.concept(values.POPULAR_INSURANCE))
    group = insured.groupBy(F.col("encounter_id").alias("_encounter")).agg(
        F.max_by("obs_group_id", "obs_id").alias("seguro_popular_obs_group_id")
    )
    answers = pivot_obs(
        obs,
        "encounter_id",
        [
            Measure("civil_status", values.CIVIL_STATUS, "coded_list"),
            Measure("occupation", values.OCCUPATION, "coded_list"),
        ],
        dictionary,
    ).withColumnRenamed("encounter_id", "_encounter")
    policy = pivot_obs(
        obs,
        "obs_group_id",
        [Measure("seguro_popular_policy_number", values.POLICY_NUMBER, "text")],
        dictionary,
    ).withColumnRenamed("obs_group_id", "_group")
    for table in (group, answers):
        rows = left_lookup(rows, table, "registration_encounter_id", "_encounter", "patient_id")
    rows = left_lookup(rows, policy, "seguro_popular_obs_group_id", "_group", "patient_id")

    for table in (clinic.people(), clinic.names(patients), clinic.addresses(patients),
                  clinic.phones(patients=patients),
                  clinic.identifiers(values.NATIONAL_ID, "curp", patients)):
        rows = rows.join(table, "patient_id", "left")
    surname = F.trim("family_name")
    return rows.select(
        "patient_id",
        surname.alias("lastname"),
        text.paternal_surname(surname).alias("paternal_lastname"),
        text.maternal_surname(surname).alias("maternal_lastname"),
        F.col("given_name").alias("firstname"),
        "registration_encounter_id",
        F.to_date("registration_datetime").alias("registration_date"),
        "seguro_popular_obs_group_id",
        "seguro_popular_policy_number",
        "birthdate",
        "gender",
        "civil_status",
        "occupation",
        F.col("address1").alias("address"),
        F.col("city_village").alias("localidad"),
        F.col("county_district").alias("municipio"),
        "telephone",
        "curp",
    )
