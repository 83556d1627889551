"""Visit, diagnosis and epidemiology statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eavista import values
from eavista.functions import ages
from eavista.operators.filters import Day, active
from eavista.operators.joins import left_lookup, with_earlier_visit_flag, with_first_time_flag
from eavista.operators.latest import latest_per_key, newest
from eavista.operators.obs import Measure, narrow_obs, of_concepts, pivot_obs, staged_obs
from eavista.sources.clinic import Clinic


def _countable_encounters(clinic: Clinic, start: Day, end: Day, type_uuid: str | None) -> DataFrame:
    """Live encounters in range of live patients who are not test patients."""
    rows = clinic.encounters(type_uuid, start, end).select(
        "encounter_id", "patient_id", "visit_id", "encounter_datetime", "location_id"
    )
    return clinic.without_test_patients(rows.join(clinic.live_patients(), "patient_id", "left_semi"))


def _with_person(clinic: Clinic, rows: DataFrame, encounters: DataFrame) -> DataFrame:
    """Add person and name; only the names of the encounters' patients are ranked."""
    people = clinic.people().join(clinic.names(encounters), "patient_id")
    return rows.join(people, "patient_id")


def _insured(clinic: Clinic, rows: DataFrame) -> DataFrame:
    """(patient_id, insured) from the newest insurance observation of each patient in ``rows``."""
    dictionary = clinic.dictionary
    patients = rows.select(F.col("patient_id").alias("person_id")).distinct()
    rows = of_concepts(clinic.active("obs"), [values.INSURANCE], dictionary).select(
        "person_id", "obs_id", "date_created", "value_coded"
    ).join(patients, "person_id", "left_semi")
    last = latest_per_key(rows, "person_id", *newest("date_created", "obs_id"))
    last = dictionary.with_role(last, "value_coded", {"popular": values.POPULAR_INSURANCE}, "_kind")
    return last.select(F.col("person_id").alias("patient_id"), F.col("_kind").alias("insured"))


def _per_visit(rows: DataFrame, *more: str) -> DataFrame:
    """One row per visit, taken from its first encounter; an encounter without a visit is its own."""
    loose = F.when(F.col("visit_id").isNull(), F.col("encounter_id"))
    keys = ["visit_id", "_loose", *more]
    kept = [c for c in rows.columns if c not in keys]
    # `more` may be null, which groupBy keeps as one value
    first = F.min(F.struct("encounter_datetime", "encounter_id", *[
        c for c in kept if c not in ("encounter_datetime", "encounter_id")
    ])).alias("_first")
    return (
        rows.withColumn("_loose", loose).groupBy(*keys).agg(first).select(*keys, "_first.*")
        .drop("_loose")
    )


def _live_visit(clinic: Clinic, rows: DataFrame) -> DataFrame:
    """Blank the visit id of encounters whose visit is voided or missing."""
    visits = clinic.active("visit").select(F.col("visit_id").alias("_visit"),
                                           F.lit(True).alias("_live"))
    joined = left_lookup(rows, visits, "visit_id", "_visit", "encounter_id")
    return joined.withColumn("visit_id", F.when(F.col("_live"), F.col("visit_id"))).drop("_live")


def _earlier_visits(clinic: Clinic, encounters: DataFrame, include_voided: bool) -> DataFrame:
    """(_visit, _again) of the encounters' visits, from their patients' visits of the same years only."""
    due = clinic.active("visit").join(
        encounters.select("visit_id").filter("visit_id IS NOT NULL").distinct(), "visit_id", "left_semi"
    )
    pairs = due.select("patient_id", F.year("date_started").alias("_year")).distinct()
    history = clinic["visit"] if include_voided else clinic.active("visit")
    history = history.withColumn("_year", F.year("date_started")).join(pairs, ["patient_id", "_year"], "left_semi")
    flagged = with_earlier_visit_flag(due, history.drop("_year"), "_again")
    return flagged.select(F.col("visit_id").alias("_visit"), "_again")


def visits(clinic: Clinic, start: Day, end: Day, include_voided: bool = False) -> DataFrame:
    """One row per visit: date, name, age, gender, insurance flag, first visit of the year."""
    encounters = _countable_encounters(clinic, start, end, None)
    rows = _per_visit(_live_visit(clinic, encounters))
    rows = _with_person(clinic, rows, encounters)
    rows = rows.join(_insured(clinic, encounters), "patient_id", "left")
    rows = left_lookup(rows, _earlier_visits(clinic, encounters, include_voided), "visit_id", "_visit", "encounter_id")
    rows = clinic.with_location(rows, "location_id", "Clinica", "encounter_id")
    return rows.select(
        ages.date_and_time_text(F.col("encounter_datetime")).alias("Fecha"),
        F.concat("given_name", F.lit(" "), "family_name").alias("Nombre"),
        ages.decimal_years(F.col("birthdate"), F.col("encounter_datetime")).alias("Edad"),
        F.col("gender").alias("Genero"),
        F.when(F.col("insured").isNotNull(), "1").otherwise("").alias("SPSS"),
        F.when(F.coalesce(F.col("_again"), F.lit(False)), "").otherwise("1").alias("1a visita"),
        "Clinica",
    )


def _coded_diagnoses(clinic: Clinic, obs: DataFrame, encounters: DataFrame) -> DataFrame:
    """Live coded diagnosis observations of the encounters."""
    rows = clinic.dictionary.only_role(
        obs, "concept_id", {"diagnosis": values.DIAGNOSIS}, "_role"
    )
    return rows.select(
        "encounter_id", "obs_id", "obs_group_id", "person_id", "value_coded", "date_created"
    ).join(encounters.select("encounter_id"), "encounter_id", "left_semi")


def _with_diagnosis_labels(clinic: Clinic, obs: DataFrame, rows: DataFrame) -> DataFrame:
    """Add the name ``Dx``, the code ``ICD-10`` and whether the certainty reads confirmed."""
    dictionary = clinic.dictionary
    labels = (
        active(dictionary.names)
        .filter(F.col("locale") == dictionary.locale)
        .groupBy("concept_id")
        .agg(F.max("name").alias("Dx"))
    )
    icd = dictionary.codes_of(values.ICD10, "max").withColumnRenamed("code", "ICD-10")
    certainty_names = (
        active(dictionary.names)
        .filter((F.col("locale") == dictionary.locale) & (F.col("locale_preferred") == 1))
        .groupBy("concept_id")
        .agg(F.max("name").alias("name"))
    )
    certainty = pivot_obs(
        obs,
        "obs_group_id",
        [Measure("_certainty", values.DIAGNOSIS_CERTAINTY_ARCHIVE, "coded_name", pick="first")],
        dictionary,
        names=certainty_names,
    ).withColumnRenamed("obs_group_id", "_group")
    rows = left_lookup(rows, certainty, "obs_group_id", "_group", "encounter_id")
    for table in (labels, icd):
        rows = left_lookup(
            rows, table.withColumnRenamed("concept_id", "_concept"), "value_coded", "_concept",
            "encounter_id",
        )
    confirmed = F.lower("_certainty") == values.CONFIRMED_NAME.lower()
    return rows.withColumn("Confirmado", F.when(confirmed, "1").otherwise(" "))


def _diagnosis_obs(clinic: Clinic, encounters: DataFrame) -> DataFrame:
    """Diagnoses and their certainty in the encounters; a group's members belong to one encounter."""
    codes = [values.DIAGNOSIS, values.DIAGNOSIS_CERTAINTY_ARCHIVE]
    narrowed = narrow_obs(clinic["obs"], encounters, codes=codes, dictionary=clinic.dictionary)
    return staged_obs(narrowed, "visit-diagnoses")


def visit_diagnoses(clinic: Clinic, start: Day, end: Day) -> DataFrame:
    """One row per visit and coded diagnosis; a visit without diagnosis has one row."""
    encounters = _live_visit(clinic, _countable_encounters(clinic, start, end, None))
    obs = _diagnosis_obs(clinic, encounters)
    coded = _coded_diagnoses(clinic, obs, encounters).select(
        "encounter_id", F.col("obs_id").alias("dx_obs_id"), "obs_group_id", "value_coded"
    )
    rows = _per_visit(encounters.join(coded, "encounter_id", "left"), "value_coded")
    rows = _with_person(clinic, rows, encounters).join(_insured(clinic, encounters), "patient_id", "left")
    rows = _with_diagnosis_labels(clinic, obs, rows)
    rows = clinic.with_location(rows, "location_id", "Clinica", "encounter_id")
    return rows.select(
        ages.date_and_time_text(F.col("encounter_datetime")).alias("Fecha"),
        F.concat("given_name", F.lit(" "), "family_name").alias("Nombre"),
        ages.decimal_years(F.col("birthdate"), F.col("encounter_datetime")).alias("Edad"),
        F.col("gender").alias("Genero"),
        F.when(F.col("insured").isNotNull(), "1").otherwise("").alias("SPSS"),
        "Confirmado",
        "Dx",
        "ICD-10",
        "Clinica",
    )


def epidemiology(clinic: Clinic, start: Day, end: Day, include_voided: bool = False) -> DataFrame:
    """One row per coded diagnosis in a consult, with a first-time flag."""
    encounters = _countable_encounters(clinic, start, end, values.CONSULT)
    obs = _diagnosis_obs(clinic, encounters)
    rows = _coded_diagnoses(clinic, obs, encounters).join(encounters, "encounter_id")
    history = clinic["obs"] if include_voided else clinic.active("obs")
    pairs = rows.select("person_id", "value_coded").distinct()
    rows = with_first_time_flag(
        rows,
        history.select("person_id", "value_coded", "date_created")
        .join(pairs, ["person_id", "value_coded"], "left_semi"),
        ["person_id", "value_coded"], "date_created", "_first",
    )
    towns = clinic.addresses(encounters).select("patient_id", F.col("city_village").alias("De donde es"))
    rows = _with_person(clinic, rows, encounters).join(towns, "patient_id", "left")
    rows = _with_diagnosis_labels(clinic, obs, rows)
    rows = clinic.with_location(rows, "location_id", "Clinica", "encounter_id")
    return rows.select(
        ages.date_and_time_text(F.col("encounter_datetime")).alias("Fecha"),
        F.concat("given_name", F.lit(" "), "family_name").alias("Nombre"),
        "Dx",
        "ICD-10",
        F.when(F.col("_first"), "1").otherwise(" ").alias("1a vez"),
        "Confirmado",
        ages.decimal_years(F.col("birthdate"), F.col("encounter_datetime")).alias("Edad"),
        F.col("gender").alias("Genero"),
        "De donde es",
        "Clinica",
    )
