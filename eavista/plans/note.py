"""Clinical note: one row per consult with vitals, tests, diagnoses, plan and treatment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eavista import values
from eavista.functions import ages, clinical, text
from eavista.operators.filters import Day
from eavista.operators.latest import number_rows
from eavista.operators.obs import (
    Measure, measures, medication_lines, narrow_obs, ordered_list, pivot_obs, rapid_test_lines,
    staged_obs,
)
from eavista.plans.history import latest_vitals_in_visit, with_visit_vitals
from eavista.plans.registration import latest_registration
from eavista.session import stage
from eavista.sources.clinic import Clinic


def coded_diagnosis_lists(
    clinic: Clinic, obs: DataFrame, keep_incomplete: bool = False
) -> DataFrame:
    """(encounter_id, diagnoses): name and ICD-10 code of each coded diagnosis.

    A diagnosis without a name or code is left out, or kept without the missing part.
    """
    dictionary = clinic.dictionary
    rows = dictionary.only_role(obs, "concept_id", {"dx": values.DIAGNOSIS}, "_role")
    rows = dictionary.with_name(rows, "value_coded", "name", "obs_id")
    rows = dictionary.with_code(rows, "value_coded", values.ICD10, "code", "obs_id")
    shown = F.concat("name", F.lit(" "), "code")
    if keep_incomplete:
        shown = text.join_present(" ", F.col("name"), F.col("code"))
    return (
        rows.withColumn("_shown", shown)
        .groupBy("encounter_id")
        .agg(ordered_list("_shown", ", ", "obs_id").alias("diagnoses"))
    )


def dose_text(number: int) -> Column:
    """``Dosis 1: 2 tableta, Mañana: 1``; null without a dose."""
    dose = f"dose_{number}"
    units = F.concat(F.lit(" "), F.col(f"{dose}_units"))
    times = [text.prefixed(label, F.col(f"{dose}_{part}"))
             for part, label in values.DAY_LABELS.items()]
    head = F.concat(F.lit(f"Dosis {number}: "), text.number_text(dose))
    return F.when(F.col(dose).isNotNull(), F.concat_ws("", head, units, *times))


def treatment_lists(lines: DataFrame, keep_incomplete: bool = False) -> DataFrame:
    """(encounter_id, treatment): the medication lines of each encounter as one text.

    A line without a drug name or first dose is left out, or kept with what it has.
    """
    first, second = dose_text(1), dose_text(2)
    doses = F.concat_ws(", ", first, second)
    shown = F.when(first.isNotNull(), F.concat("name", F.lit(": "), doses))
    if keep_incomplete:
        shown = text.join_present(": ", F.col("name"), F.nullif(doses, F.lit("")))
    return (
        lines.withColumn("_shown", shown)
        .groupBy("encounter_id")
        .agg(ordered_list("_shown", ", ", "obs_group_id").alias("treatment"))
    )


def clinical_note(
    clinic: Clinic, start: Day, end: Day, keep_incomplete: bool = False
) -> DataFrame:
    dictionary = clinic.dictionary
    base = (
        clinic.encounters(values.CONSULT, start, end)
        .join(clinic.live_patients(), "patient_id", "left_semi")
        .select("encounter_id", "patient_id", "visit_id", "encounter_datetime", "location_id")
    )
    # the range's encounters, written once as many joins need them
    base = stage(number_rows(base, "consult_id", "encounter_datetime", "encounter_id"), "consults")
    registered = latest_registration(clinic, base).drop("registration_datetime")
    latest = latest_vitals_in_visit(clinic, base)
    # the consults, the vitals of their visits and the registrations, in one pass
    codes = [m[1] for table in (values.NOTE_CONSULT, values.NOTE_VITALS, values.MEDICATION_MEASURES)
             for m in table]
    codes += [*values.RAPID_TESTS, values.DIAGNOSIS, values.MEDICATION_GROUP, values.POLICY_NUMBER]
    keys = (
        base,
        latest.select(F.col("vitals_encounter_id").alias("encounter_id")),
        registered.select(F.col("registration_encounter_id").alias("encounter_id")),
    )
    obs = staged_obs(narrow_obs(clinic["obs"], *keys, codes=codes, dictionary=dictionary), "note")

    answers = pivot_obs(obs, "encounter_id", measures(values.NOTE_CONSULT), dictionary)
    tests = rapid_test_lines(obs, dictionary).groupBy("encounter_id").agg(
        ordered_list("display_name", " ", "obs_id").alias("rapid_test_results")
    )
    lines = medication_lines(obs, dictionary, clinic["drug"])
    rows = base
    for table in (answers, tests, coded_diagnosis_lists(clinic, obs, keep_incomplete),
                  treatment_lists(lines, keep_incomplete), clinic.providers(encounters=base)):
        rows = rows.join(table, "encounter_id", "left")
    rows = with_visit_vitals(clinic, rows, latest, obs, measures(values.NOTE_VITALS))
    rows = clinic.with_location(rows, "location_id", "encounter_location", "encounter_id")

    registered = clinic.with_location(
        registered, "registration_location_id", "registration_location_name", "patient_id"
    )
    policy = pivot_obs(
        obs, "encounter_id",
        [Measure("insurance_policy_number", values.POLICY_NUMBER, "text")], dictionary,
    ).withColumnRenamed("encounter_id", "registration_encounter_id")
    registered = registered.join(policy, "registration_encounter_id", "left")
    for table in (clinic.people(), clinic.names(base), registered):
        rows = rows.join(table, "patient_id", "left")
    return rows.select(*_note_columns(rows))


def _note_columns(rows: DataFrame) -> list[Column]:
    date = F.to_date("encounter_datetime")
    born = F.col("birthdate")
    lists = {c: text.prefixed(label, F.col(c)) for c, label in {
        "presenting_history": "S: ",
        "physical_exam": "Exploración Física: ",
        "glucose_fasting": "Ayuno: ",
        "diagnoses": "Diagnóstico: ",
        "plan": "Indicaciones Médicas: ",
    }.items()}
    number = lambda label, c: F.concat(F.lit(label), text.number_text(c))
    glucose = "coalesce(vitals_glucose, consult_glucose)"
    ultrasound = text.prefixed(
        "Ultrasonido: ",
        text.join_present(", ", F.col("ultrasound_type"), F.col("ultrasound_notes")),
    )
    glucose_line = text.join_present(
        ", ", number("Glucosa: ", glucose), lists["glucose_fasting"], number("Hba1c: ", "hba1c"),
        number("Proteinuria: ", "proteinuria"),
    )
    cholesterol_line = text.join_present(
        ", ", number("Colesterol: ", "cholesterol"), number("HDL: ", "hdl"), number("LDL: ", "ldl")
    )
    first, last = F.trim("given_name"), F.trim("family_name")
    facility = lambda c: text.recode(
        F.col(c), values.NOTE_FACILITIES, F.col("encounter_location")
    )
    computed = {
        "encounter_date": date,
        "encounter_time": F.date_format("encounter_datetime", "HH:mm"),
        "unidad_medica": facility("encounter_location"),
        "first_name": first,
        "last_name": last,
        "patient_name": F.trim(F.concat_ws(" ", "given_name", "family_name")),
        "age_years": ages.full_years(born, date),
        "age_months": ages.months_after_year(born, date),
        "age_days": ages.days_after_month(born, date),
        "gender_display": F.try_element_at(text.fixed_map(values.GENDER_DISPLAY), F.col("gender")),
        # an unknown registration place falls back to the place of the consult
        "procedencia": facility("registration_location_name"),
        "height_m": F.col("height_cm") / 100,
        "bmi": clinical.bmi(F.col("weight_kg"), F.col("height_cm")),
        "systolic": F.round("systolic").cast("int"),
        "diastolic": F.round("diastolic").cast("int"),
        "heart_rate": F.round("heart_rate").cast("int"),
        "respiratory_rate": F.round("respiratory_rate").cast("int"),
        "glucose_mg_dl": F.expr(glucose),
        "subjective": lists["presenting_history"],
        "physical_exam_line": lists["physical_exam"],
        "ultrasound_line": ultrasound,
        "hba1c": text.number_text("hba1c"),
        "proteinuria": text.number_text("proteinuria"),
        "glucose_line": glucose_line,
        "cholesterol_line": cholesterol_line,
        "test_results": text.join_present(
            "\n", lists["physical_exam"], ultrasound, glucose_line, cholesterol_line
        ),
        "diagnoses_and_plan": text.join_present("\n", lists["diagnoses"], lists["plan"]),
        "sheet_name": text.sheet_name(date, F.col("encounter_id"), last),
    }
    order = (
        "consult_id encounter_id patient_id visit_id encounter_datetime encounter_date "
        "encounter_time location_id encounter_location unidad_medica provider first_name "
        "last_name patient_name age_years age_months age_days birthdate gender gender_display "
        "registration_encounter_id registration_location_name procedencia "
        "insurance_policy_number vitals_encounter_id weight_kg height_cm height_m bmi systolic "
        "diastolic heart_rate respiratory_rate temp_c glucose_mg_dl chief_complaint waist_cm "
        "subjective analysis physical_exam physical_exam_line ultrasound_type ultrasound_notes "
        "ultrasound_line glucose_fasting hba1c proteinuria glucose_line cholesterol hdl ldl "
        "cholesterol_line test_results diagnoses plan diagnoses_and_plan rapid_test_results "
        "treatment sheet_name"
    ).split()
    return [computed[c].alias(c) if c in computed else F.col(c) for c in order]
