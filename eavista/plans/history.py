"""Clinical history: one row per history encounter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eavista import values
from eavista.functions import ages, clinical, text
from eavista.operators.filters import Day
from eavista.operators.joins import left_lookup
from eavista.operators.latest import latest_per_key, newest
from eavista.operators.obs import (
    Measure, measures, narrow_obs, ordered_list, pivot_obs, staged_obs,
)
from eavista.sources.clinic import Clinic


def latest_vitals_in_visit(clinic: Clinic, visits: DataFrame) -> DataFrame:
    """(visit_id, vitals_encounter_id): the newest vitals encounter of each of the visits."""
    rows = clinic.encounters(values.VITALS).select("encounter_id", "visit_id", "encounter_datetime")
    wanted = visits.select("visit_id").filter("visit_id IS NOT NULL").distinct()
    rows = rows.join(wanted, "visit_id", "left_semi")
    return latest_per_key(rows, "visit_id", *newest("encounter_datetime", "encounter_id")).select(
        "visit_id", F.col("encounter_id").alias("vitals_encounter_id")
    )


def with_visit_vitals(
    clinic: Clinic, rows: DataFrame, latest: DataFrame, obs: DataFrame, wanted: list[Measure]
) -> DataFrame:
    """Add the measures of the latest vitals encounter of the same visit."""
    measured = pivot_obs(obs, "encounter_id", wanted, clinic.dictionary).withColumnRenamed(
        "encounter_id", "vitals_encounter_id"
    )
    per_visit = latest.join(measured, "vitals_encounter_id", "left").withColumnRenamed(
        "visit_id", "_visit"
    )
    return left_lookup(rows, per_visit, "visit_id", "_visit", "encounter_id")


def _latest_exams(clinic: Clinic, obs: DataFrame) -> DataFrame:
    """(encounter_id, pap, breast): the newest procedure group of each kind, as a struct.

    One aggregate describes every procedure group (its date, comment, result and the markers it
    contains), a second one picks the latest marked group per encounter: the latest date, then
    the highest group id.
    """
    dictionary = clinic.dictionary
    rows = obs.filter("obs_group_id IS NOT NULL")
    parts = {"date": values.PROCEDURE_DATE, "comment": values.PROCEDURE_COMMENT,
             "result": values.PAP_SMEAR}
    rows = dictionary.with_role(rows, "concept_id", parts, "_part")
    markers = {"pap": values.PAP_SMEAR, "breast": values.BREAST_EXAM}
    rows = dictionary.with_role(rows, "value_coded", markers, "_marker")
    rows = rows.filter("_part IS NOT NULL OR _marker IS NOT NULL")
    names = dictionary.best_names().select(
        F.col("concept_id").alias("_concept"), F.col("name").alias("_name"))
    rows = left_lookup(rows, names, "value_coded", "_concept", "obs_id")
    groups = rows.groupBy("encounter_id", "obs_group_id").agg(
        F.expr("max(value_datetime) FILTER (WHERE _part = 'date')").alias("at"),
        F.expr("max_by(value_text, obs_id) FILTER (WHERE _part = 'comment' "
               "AND value_text IS NOT NULL)").alias("comment"),
        ordered_list("_name", values.LIST_SEPARATOR, "obs_id", where="_part = 'result'").alias("result"),
        F.max(F.expr("coalesce(_marker = 'pap', false)")).alias("is_pap"),
        F.max(F.expr("coalesce(_marker = 'breast', false)")).alias("is_breast"),
    )
    described = "max(struct(at, obs_group_id, result, comment)) FILTER (WHERE {} AND at IS NOT NULL)"
    return groups.groupBy("encounter_id").agg(
        F.expr(described.format("is_pap")).alias("_pap"),
        F.expr(described.format("is_breast")).alias("_breast"),
    )


def history(
    clinic: Clinic, start: Day = None, end: Day = None, patient_id: int | None = None
) -> DataFrame:
    """The named patient's histories, or those of the date range."""
    base = clinic.encounters(values.CLINICAL_HISTORY, start, end, patient_id).select(
        "encounter_id", "patient_id", "visit_id", "location_id", "encounter_datetime",
        "date_created",
    )
    latest = latest_vitals_in_visit(clinic, base)
    vitals = latest.select(F.col("vitals_encounter_id").alias("encounter_id"))
    dictionary = clinic.dictionary
    codes = [m[1] for table in (values.HISTORY_MEASURES, values.HISTORY_VITALS) for m in table]
    codes += [values.PROCEDURE_DATE, values.PROCEDURE_COMMENT, values.PAP_SMEAR]
    # a marker of an examination may be the answer of any concept
    shown = [c for c in dictionary.ids(codes).values() if c is not None]
    marks = [c for c in dictionary.ids([values.PAP_SMEAR, values.BREAST_EXAM]).values() if c is not None]
    wanted = clinic["obs"].filter(F.col("concept_id").isin(*shown) | F.col("value_coded").isin(*marks))
    obs = staged_obs(narrow_obs(wanted, base, vitals), "history")
    answers = pivot_obs(obs, "encounter_id", measures(values.HISTORY_MEASURES), clinic.dictionary)
    rows = base
    for table in (answers, _latest_exams(clinic, obs), clinic.providers(encounters=base)):
        rows = rows.join(table, "encounter_id", "left")
    rows = with_visit_vitals(clinic, rows, latest, obs, measures(values.HISTORY_VITALS))
    rows = clinic.with_location(rows, "location_id", "location_name", "encounter_id")
    for table in (clinic.people(), clinic.names(base), clinic.addresses(base), clinic.phones(patients=base)):
        rows = rows.join(table, "patient_id", "left")
    rows = rows.withColumns({
        "latest_pap_smear_date": F.to_date("_pap.at"),
        "pap_smear_result": F.col("_pap.result"),
        "pap_smear_comments": F.col("_pap.comment"),
        "latest_breast_exam_date": F.to_date("_breast.at"),
        "breast_exam_obs_group_id": F.col("_breast.obs_group_id"),
        "breast_exam_comments": F.col("_breast.comment"),
    })

    kinds = {name: kind for name, _, kind in values.HISTORY_MEASURES}

    def shown(column: str) -> str:
        return text.number_sql(column) if kinds.get(column) == "numeric" else f"string({column})"

    def sentence(labels: tuple) -> Column:
        return text.labelled_sentence((label, shown(column)) for label, column in labels)

    lifestyle = ("feeding", "housing", "home_occupation", "hygiene", "vaccine",
                 "other_non_path_history")
    comma_list = lambda c: F.replace(c, F.lit(values.LIST_SEPARATOR), F.lit(", "))
    date = F.to_date("encounter_datetime")
    surname = F.col("family_name") if patient_id is None else None
    computed = {
        "encounter_date": date,
        "sheet_name": text.sheet_name(date, F.col("encounter_id"), surname),
        "full_facility_name": text.recode(F.col("location_name"), values.HISTORY_FACILITIES),
        "lastname": F.col("family_name"),
        "firstname": F.col("given_name"),
        "age": ages.full_years(F.col("birthdate"), date),
        "address": F.col("address1"),
        "localidad": F.col("city_village"),
        "family_history": comma_list(F.col("family_history")),
        "diagnoses": comma_list(F.col("diagnoses")),
        "non_pathological_history": F.concat_ws(", ", *lifestyle),
        "pathological_history": sentence(values.PATHOLOGICAL_LABELS),
        "gyn_history": sentence(values.GYNECOLOGY_LABELS),
        "genitourinary": sentence(values.GENITOURINARY_LABELS),
        "bp": clinical.blood_pressure_text("bp_systolic", "bp_diastolic"),
        "entry_date": F.to_date("date_created"),
    }
    return rows.select(
        *[computed[c].alias(c) if c in computed else c for c in values.HISTORY_COLUMNS]
    )
