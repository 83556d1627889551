"""Checks of the complete reports, over the whole date range of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from eavista import values
from eavista.catalog.eav import MEDICATION_SQL, NAMES, RAPID_SQL, listed, measure_sql
from eavista.catalog.fixture import cid
from eavista.catalog.predicates import _facility_case
from eavista.catalog.registry import ADDRESS_SQL, END, NAME_SQL, START, check
from eavista.catalog.scalars import bmi_sql, full_months_sql, full_years_sql, number_sql
from eavista.operators.filters import active
from eavista.plans import (
    diagnoses, drugs, history, note, prescriptions, registration, visits, vitals,
)

_EMR = """SELECT patient_id, identifier FROM fx_patient_identifier WHERE voided = 0 AND identifier_type = 1"""
_CURP = """SELECT patient_id, identifier FROM fx_patient_identifier WHERE voided = 0 AND identifier_type = 2"""
_PHONE = """SELECT person_id, value FROM (SELECT *, row_number() OVER (PARTITION BY person_id
  ORDER BY date_created DESC, person_attribute_id DESC) AS place FROM fx_person_attribute
  WHERE voided = 0 AND person_attribute_type_id = 2) x WHERE place = 1"""
_USER = f"""SELECT u.user_id, trim(n.given_name || ' ' || n.family_name) AS name FROM fx_users u
  JOIN ({NAME_SQL}) n ON n.person_id = u.person_id"""
_PROVIDER = """SELECT f.encounter_id, p.name FROM (SELECT encounter_id, arg_min(provider_id, encounter_provider_id)
  AS provider_id FROM fx_encounter_provider WHERE voided = 0 GROUP BY encounter_id) f
  LEFT JOIN fx_provider p ON p.provider_id = f.provider_id"""
_LIVE = "fx_patient WHERE voided = 0"
_PERSON = "(SELECT * FROM fx_person WHERE voided = 0)"
_OBS = "(SELECT * FROM fx_clinic_obs WHERE voided = 0)"
_NAMED_OBS = f"""(SELECT o.*, n.name, n.short_name FROM fx_clinic_obs o
  LEFT JOIN ({NAMES}) n ON n.concept_id = o.value_coded WHERE o.voided = 0)"""


def _ids(*rows: tuple) -> str:
    return ", ".join(str(cid(r[1])) for table in rows for r in table)


def _moment(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def _day(x: str) -> str:
    return f"CAST({x} AS DATE)"


def _day_text(x: str) -> str:
    return f"CAST({_day(x)} AS VARCHAR)"


_PATIENT = "(SELECT min(patient_id) FROM fx_encounter WHERE voided = 0 AND encounter_type = {})"
_IN_RANGE = f"CAST({{}} AS DATE) BETWEEN DATE '{START}' AND DATE '{END}'"


@check("report_meds_stock", f"""
SELECT d.name AS "Medicamento", CAST(sum(q.value_numeric) AS DOUBLE) AS "Cantidad", l.name AS "Clinica"
FROM fx_drug d LEFT JOIN {_OBS} n ON n.value_drug = d.drug_id AND {_IN_RANGE.format('n.obs_datetime')}
LEFT JOIN fx_location l ON l.location_id = n.location_id
LEFT JOIN {_OBS} q ON q.obs_group_id = n.obs_group_id AND q.concept_id = {cid(values.DISPENSED_QUANTITY)}
WHERE d.name LIKE 'SITE%' AND d.retired = 0 GROUP BY d.drug_id, d.name, l.location_id, l.name
""")
def report_meds_stock(fx):
    return drugs.meds_stock(fx.clinic, START, END, name_prefix="SITE")


@check("report_meds_dispensed", f"""
SELECT d.name AS "Medicamento", CAST(sum(q.value_numeric) AS DOUBLE) AS "Cantidad", min(l.name) AS "Clinica"
FROM {_OBS} q JOIN {_OBS} n ON n.obs_group_id = q.obs_group_id AND n.concept_id = {cid(values.MEDICATION)}
JOIN fx_drug d ON d.drug_id = n.value_drug LEFT JOIN fx_location l ON l.location_id = n.location_id
WHERE q.concept_id = {cid(values.DISPENSED_QUANTITY)} AND {_IN_RANGE.format('q.obs_datetime')}
  AND d.name LIKE 'SSA: %' GROUP BY d.drug_id, d.name
""")
def report_meds_dispensed(fx):
    return drugs.meds_dispensed(fx.clinic, START, END)


_COUNTED = f"""SELECT e.encounter_id, e.patient_id, e.encounter_datetime, e.location_id, e.encounter_type,
  v.visit_id FROM fx_encounter e JOIN (SELECT patient_id FROM {_LIVE}) p ON p.patient_id = e.patient_id
  LEFT JOIN (SELECT visit_id FROM fx_visit WHERE voided = 0) v ON v.visit_id = e.visit_id
  WHERE e.voided = 0 AND {_IN_RANGE.format('e.encounter_datetime')}
    AND e.patient_id NOT IN (SELECT person_id FROM fx_person_attribute WHERE value = 'true'
      AND person_attribute_type_id = 1 AND voided = 0)"""
_VISIT_KEY = "visit_id, CASE WHEN visit_id IS NULL THEN encounter_id END"
_INSURED = f"""SELECT person_id, arg_max(value_coded, struct_pack(d := date_created, o := obs_id))
  = {cid(values.POPULAR_INSURANCE)} AS insured FROM {_OBS} i WHERE concept_id = {cid(values.INSURANCE)}
  GROUP BY person_id"""
_PERSON_COLUMNS = f"""strftime(r.encounter_datetime, '%Y-%m-%d %H:%M:%S') AS "Fecha",
  n.given_name || ' ' || n.family_name AS "Nombre",
  round(date_diff('day', p.birthdate, CAST(r.encounter_datetime AS DATE)) / 365.25, 1) AS "Edad",
  p.gender AS "Genero", l.name AS "Clinica" """
_PERSON_JOINS = f"""JOIN {_PERSON} p ON p.person_id = r.patient_id JOIN ({NAME_SQL}) n ON n.person_id = r.patient_id
  LEFT JOIN fx_location l ON l.location_id = r.location_id"""


@check("report_visits", f"""
WITH e AS ({_COUNTED}), r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_VISIT_KEY}
  ORDER BY encounter_datetime, encounter_id) AS place FROM e) x WHERE place = 1)
SELECT {_PERSON_COLUMNS}, CASE WHEN i.insured THEN '1' ELSE '' END AS "SPSS",
  CASE WHEN EXISTS (SELECT 1 FROM fx_visit v JOIN fx_visit w ON w.patient_id = v.patient_id AND w.voided = 0
    AND w.date_stopped < v.date_started AND year(w.date_started) = year(v.date_started)
    WHERE v.visit_id = r.visit_id) THEN '' ELSE '1' END AS "1a visita"
FROM r {_PERSON_JOINS} LEFT JOIN ({_INSURED}) i ON i.person_id = r.patient_id
""")
def report_visits(fx):
    return visits.visits(fx.clinic, START, END)


_DX_LABELS = """LEFT JOIN (SELECT concept_id, max(name) AS name FROM fx_concept_name WHERE voided = 0
    AND locale = 'es' GROUP BY 1) dn ON dn.concept_id = r.value_coded
  LEFT JOIN (SELECT concept_id, max(code) AS code FROM fx_concept_mapping WHERE source = 'ICD-10-WHO' GROUP BY 1)
    dc ON dc.concept_id = r.value_coded"""
_CONFIRMED_SQL = f"""CASE WHEN (SELECT arg_min(value_coded, obs_id) FROM {_OBS} c WHERE c.obs_group_id = r.obs_group_id
    AND c.concept_id = {cid(values.DIAGNOSIS_CERTAINTY)}) = {cid(values.CONFIRMED)} THEN '1' ELSE ' ' END"""
_DX_ROWS = f"""SELECT obs_id, encounter_id, obs_group_id, person_id, value_coded, date_created FROM {_OBS} x
  WHERE concept_id = {cid(values.DIAGNOSIS)}"""


@check("report_visit_diagnoses", f"""
WITH e AS ({_COUNTED}), d AS ({_DX_ROWS}), j AS (SELECT e.*, d.obs_id, d.obs_group_id, d.value_coded
  FROM e LEFT JOIN d ON d.encounter_id = e.encounter_id),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_VISIT_KEY}, value_coded
  ORDER BY encounter_datetime, encounter_id, obs_id) AS place FROM j) x WHERE place = 1)
SELECT {_PERSON_COLUMNS}, CASE WHEN i.insured THEN '1' ELSE '' END AS "SPSS",
  {_CONFIRMED_SQL} AS "Confirmado", dn.name AS "Dx", dc.code AS "ICD-10"
FROM r {_PERSON_JOINS} LEFT JOIN ({_INSURED}) i ON i.person_id = r.patient_id {_DX_LABELS}
""")
def report_visit_diagnoses(fx):
    return visits.visit_diagnoses(fx.clinic, START, END)


@check("report_epidemiology", f"""
WITH e AS ({_COUNTED}), d AS ({_DX_ROWS}), r AS (SELECT e.patient_id, e.encounter_datetime, e.location_id, d.*
  FROM d JOIN e ON e.encounter_id = d.encounter_id WHERE e.encounter_type = 1)
SELECT {_PERSON_COLUMNS}, dn.name AS "Dx", dc.code AS "ICD-10", {_CONFIRMED_SQL} AS "Confirmado",
  CASE WHEN EXISTS (SELECT 1 FROM {_OBS} w WHERE w.person_id = r.person_id AND w.value_coded = r.value_coded
    AND w.date_created < r.date_created) THEN ' ' ELSE '1' END AS "1a vez", a.city_village AS "De donde es"
FROM r {_PERSON_JOINS} LEFT JOIN ({ADDRESS_SQL}) a ON a.person_id = r.patient_id {_DX_LABELS}
""")
def report_epidemiology(fx):
    return visits.epidemiology(fx.clinic, START, END)


@check("report_diagnoses", f"""
WITH o AS (SELECT * FROM {_NAMED_OBS} x)
SELECT e.patient_id, e.encounter_id, {_moment('e.encounter_datetime')} AS encounter_datetime,
  {_moment('o.date_created')} AS date_created, u.name AS entered_by, l.name AS encounter_location,
  {full_years_sql('p.birthdate', _day('e.encounter_datetime'))} AS age_at_encounter, i.identifier AS emr_id,
  CAST(p.birthdate AS VARCHAR) AS birthdate, p.gender, CASE WHEN o.value_coded IS NOT NULL THEN o.name
    ELSE o.value_text END AS diagnosis, (SELECT min(code) FROM fx_concept_mapping m
    WHERE m.concept_id = o.value_coded AND m.source = 'ICD-10-WHO') AS diagnosis_icd10_code,
  (SELECT arg_min(s.name, s.obs_id) FROM o s WHERE s.obs_group_id = o.obs_group_id
     AND s.concept_id = {cid(values.DIAGNOSIS_ORDER)}) AS diagnosis_order,
  CASE WHEN (SELECT arg_min(s.value_coded, s.obs_id) FROM o s WHERE s.obs_group_id = o.obs_group_id
     AND s.concept_id = {cid(values.DIAGNOSIS_CERTAINTY)}) = {cid(values.CONFIRMED)} THEN 'Sí' END AS first_time
FROM o JOIN fx_encounter e ON e.encounter_id = o.encounter_id AND e.voided = 0
JOIN (SELECT patient_id FROM {_LIVE}) q ON q.patient_id = e.patient_id
LEFT JOIN {_PERSON} p ON p.person_id = e.patient_id LEFT JOIN ({_USER}) u ON u.user_id = o.creator
LEFT JOIN fx_location l ON l.location_id = e.location_id LEFT JOIN ({_EMR}) i ON i.patient_id = e.patient_id
WHERE o.concept_id IN ({cid(values.DIAGNOSIS)}, {cid(values.DIAGNOSIS_TEXT)})
  AND {_IN_RANGE.format('e.encounter_datetime')}
""")
def report_diagnoses(fx):
    return diagnoses.diagnoses(fx.clinic, START, END)


@check("report_vitals", f"""
SELECT e.encounter_id, e.patient_id, e.visit_id, {_moment('e.encounter_datetime')} AS encounter_datetime,
  {_moment('e.date_created')} AS date_created, u.name AS entered_by, l.name AS encounter_location,
  {full_years_sql('p.birthdate', _day('e.encounter_datetime'))} AS age_at_encounter, i.identifier AS emr_id,
  CAST(p.birthdate AS VARCHAR) AS birthdate, p.gender, m.* EXCLUDE (encounter_id),
  {bmi_sql('m.weight_kg', 'm.height_cm')} AS bmi
FROM fx_encounter e JOIN (SELECT patient_id FROM {_LIVE}) q ON q.patient_id = e.patient_id
LEFT JOIN (SELECT encounter_id, {measure_sql(values.VITALS_MEASURES)} FROM {_NAMED_OBS} o
  WHERE concept_id IN ({_ids(values.VITALS_MEASURES)}) GROUP BY encounter_id) m ON m.encounter_id = e.encounter_id
LEFT JOIN {_PERSON} p ON p.person_id = e.patient_id LEFT JOIN ({_USER}) u ON u.user_id = e.creator
LEFT JOIN fx_location l ON l.location_id = e.location_id LEFT JOIN ({_EMR}) i ON i.patient_id = e.patient_id
WHERE e.voided = 0 AND e.encounter_type = 2 AND {_IN_RANGE.format('e.encounter_datetime')}
""")
def report_vitals(fx):
    """One row per vitals encounter: 15 measures, body mass index, demographics."""
    return vitals.vitals(fx.clinic, START, END)


_REGISTERED = """SELECT * FROM (SELECT encounter_id, patient_id, encounter_datetime, location_id, row_number() OVER
  (PARTITION BY patient_id ORDER BY encounter_datetime DESC, encounter_id DESC) AS place FROM fx_encounter
  WHERE voided = 0 AND encounter_type = 3) x WHERE place = 1"""


_FRONT_SHEET = f"""
WITH t AS (SELECT DISTINCT patient_id FROM fx_encounter WHERE voided = 0 AND encounter_type = 1
  AND @which), g AS (SELECT encounter_id, arg_max(obs_group_id, obs_id) AS id
  FROM {_OBS} o WHERE concept_id = {cid(values.INSURANCE)} AND value_coded = {cid(values.POPULAR_INSURANCE)}
  GROUP BY encounter_id)
SELECT t.patient_id, trim(n.family_name) AS lastname, trim(split_part(trim(n.family_name), ' ', 1)) AS paternal_lastname,
  CASE WHEN position(' ' IN trim(n.family_name)) > 0 THEN
    trim(substr(trim(n.family_name), position(' ' IN trim(n.family_name)))) END AS maternal_lastname,
  n.given_name AS firstname, r.encounter_id AS registration_encounter_id,
  {_day_text('r.encounter_datetime')} AS registration_date, g.id AS seguro_popular_obs_group_id,
  (SELECT arg_max(value_text, obs_id) FROM {_OBS} x WHERE x.obs_group_id = g.id
    AND x.concept_id = {cid(values.POLICY_NUMBER)}) AS seguro_popular_policy_number,
  CAST(p.birthdate AS VARCHAR) AS birthdate, p.gender, c.civil_status, c.occupation, a.address1 AS address,
  a.city_village AS localidad, a.county_district AS municipio, f.value AS telephone, k.identifier AS curp
FROM t LEFT JOIN ({_REGISTERED}) r ON r.patient_id = t.patient_id LEFT JOIN g ON g.encounter_id = r.encounter_id
LEFT JOIN (SELECT encounter_id, {listed(values.CIVIL_STATUS)} AS civil_status, {listed(values.OCCUPATION)} AS occupation
  FROM {_NAMED_OBS} o GROUP BY encounter_id) c ON c.encounter_id = r.encounter_id
LEFT JOIN {_PERSON} p ON p.person_id = t.patient_id LEFT JOIN ({NAME_SQL}) n ON n.person_id = t.patient_id
LEFT JOIN ({ADDRESS_SQL}) a ON a.person_id = t.patient_id LEFT JOIN ({_PHONE}) f ON f.person_id = t.patient_id
LEFT JOIN ({_CURP}) k ON k.patient_id = t.patient_id
"""


@check("report_front_sheet", _FRONT_SHEET.replace("@which", _IN_RANGE.format('encounter_datetime')))
def report_front_sheet(fx):
    return registration.front_sheet(fx.clinic, START, END)


_VISIT_VITALS = """SELECT * FROM (SELECT encounter_id, visit_id, row_number() OVER (PARTITION BY visit_id
  ORDER BY encounter_datetime DESC, encounter_id DESC) AS place FROM fx_encounter WHERE voided = 0
  AND encounter_type = 2) x WHERE place = 1 AND visit_id IS NOT NULL"""


def _sentence_sql(labels: tuple, kinds: dict[str, str]) -> str:
    parts = []
    for label, column in labels:
        shown = number_sql(column) if kinds.get(column) == "numeric" else column
        parts.append(f"CASE WHEN {column} IS NULL THEN '' ELSE '{label}' || {shown} || '. ' END")
    return " || ".join(parts)


_KINDS = {name: kind for name, _, kind in values.HISTORY_MEASURES}


def _exam_sql(marker: str, name: str, extra: str) -> str:
    dated = f"""SELECT encounter_id, obs_group_id, value_datetime FROM {_OBS} o
      WHERE concept_id = {cid(values.PROCEDURE_DATE)} AND obs_group_id IN
        (SELECT obs_group_id FROM {_OBS} x WHERE value_coded = {cid(marker)})"""
    return f"""SELECT t.encounter_id, CAST(CAST(t.at AS DATE) AS VARCHAR) AS latest_{name}_date,
      t.id AS {name}_obs_group_id, {extra}
      (SELECT arg_max(value_text, obs_id) FROM {_OBS} x WHERE x.obs_group_id = t.id
        AND x.concept_id = {cid(values.PROCEDURE_COMMENT)}) AS {name}_comments
    FROM (SELECT encounter_id, value_datetime AS at, obs_group_id AS id, row_number() OVER (PARTITION BY encounter_id
      ORDER BY value_datetime DESC, obs_group_id DESC) AS place FROM ({dated}) d) t WHERE t.place = 1"""


_PAP_RESULT = f"""(SELECT string_agg(x.name, ' | ' ORDER BY x.obs_id) FROM {_NAMED_OBS} x WHERE x.obs_group_id = t.id
  AND x.concept_id = {cid(values.PAP_SMEAR)}) AS pap_smear_result,"""
_HISTORY_FINAL = {
    "encounter_date": _day_text("encounter_datetime"),
    "sheet_name": "family_name || '-' || strftime(encounter_datetime, '%Y-%m-%d') || ' ' || encounter_id",
    "full_facility_name": _facility_case(values.HISTORY_FACILITIES, "location_name") + " END",
    "lastname": "family_name", "firstname": "given_name", "birthdate": "CAST(birthdate AS VARCHAR)",
    "age": full_years_sql("birthdate", _day("encounter_datetime")), "address": "address1",
    "localidad": "city_village", "family_history": "replace(family_history, ' | ', ', ')",
    "diagnoses": "replace(diagnoses, ' | ', ', ')",
    "non_pathological_history":
        "concat_ws(', ', feeding, housing, home_occupation, hygiene, vaccine, other_non_path_history)",
    "pathological_history": _sentence_sql(values.PATHOLOGICAL_LABELS, _KINDS),
    "gyn_history": _sentence_sql(values.GYNECOLOGY_LABELS, _KINDS),
    "genitourinary": _sentence_sql(values.GENITOURINARY_LABELS, _KINDS),
    "bp": f"CASE WHEN bp_systolic IS NULL THEN '' ELSE {number_sql('bp_systolic')} || '/' || "
          f"{number_sql('bp_diastolic')} END",
    "entry_date": _day_text("date_created"),
}


_HISTORY = f"""
WITH j AS (SELECT e.encounter_id, e.encounter_datetime, e.date_created, l.name AS location_name, n.family_name,
    n.given_name, p.birthdate, p.gender, a.address1, a.city_village, f.value AS telephone, k.name AS provider,
    m.* EXCLUDE (encounter_id), pap.* EXCLUDE (encounter_id), ex.* EXCLUDE (encounter_id), vm.* EXCLUDE (encounter_id)
  FROM fx_encounter e
  LEFT JOIN (SELECT encounter_id, {measure_sql(values.HISTORY_MEASURES)} FROM {_NAMED_OBS} o
    WHERE concept_id IN ({_ids(values.HISTORY_MEASURES)}) GROUP BY encounter_id) m ON m.encounter_id = e.encounter_id
  LEFT JOIN ({_exam_sql(values.PAP_SMEAR, 'pap_smear', _PAP_RESULT)}) pap ON pap.encounter_id = e.encounter_id
  LEFT JOIN ({_exam_sql(values.BREAST_EXAM, 'breast_exam', '')}) ex ON ex.encounter_id = e.encounter_id
  LEFT JOIN ({_VISIT_VITALS}) v ON v.visit_id = e.visit_id
  LEFT JOIN (SELECT encounter_id, {measure_sql(values.HISTORY_VITALS)} FROM {_OBS} o GROUP BY encounter_id) vm
    ON vm.encounter_id = v.encounter_id
  LEFT JOIN {_PERSON} p ON p.person_id = e.patient_id LEFT JOIN ({NAME_SQL}) n ON n.person_id = e.patient_id
  LEFT JOIN ({ADDRESS_SQL}) a ON a.person_id = e.patient_id LEFT JOIN ({_PHONE}) f ON f.person_id = e.patient_id
  LEFT JOIN ({_PROVIDER}) k ON k.encounter_id = e.encounter_id
  LEFT JOIN fx_location l ON l.location_id = e.location_id
  WHERE e.voided = 0 AND e.encounter_type = 4 AND @which)
SELECT {', '.join(f'{_HISTORY_FINAL.get(c, c)} AS {c}' for c in values.HISTORY_COLUMNS)} FROM j
"""


@check("report_clinical_history", _HISTORY.replace("@which", _IN_RANGE.format('e.encounter_datetime')))
def report_clinical_history(fx):
    return history.history(fx.clinic, START, END)


def _dose_sql(n: int) -> str:
    times = " || ".join(f"coalesce('{label}' || dose_{n}_{part}, '')" for part, label in values.DAY_LABELS.items())
    return (f"CASE WHEN dose_{n} IS NOT NULL THEN 'Dosis {n}: ' || {number_sql(f'dose_{n}')} "
            f"|| coalesce(' ' || dose_{n}_units, '') || {times} END")


_TREATMENT = f"""SELECT encounter_id, string_agg(line, ', ' ORDER BY obs_group_id) AS treatment FROM (
  SELECT encounter_id, obs_group_id, name || ': ' || {_dose_sql(1)} || coalesce(', ' || {_dose_sql(2)}, '') AS line
  FROM ({MEDICATION_SQL}) g) h GROUP BY encounter_id"""
_DX_LIST = f"""SELECT encounter_id, string_agg(o.name || ' ' || c.code, ', ' ORDER BY o.obs_id) AS diagnoses
  FROM {_NAMED_OBS} o LEFT JOIN (SELECT concept_id, min(code) AS code FROM fx_concept_mapping
    WHERE source = 'ICD-10-WHO' GROUP BY 1) c ON c.concept_id = o.value_coded
  WHERE o.concept_id = {cid(values.DIAGNOSIS)} GROUP BY encounter_id"""
_WHOLE = lambda x: f"CAST(round({x}) AS INT)"


@check("report_clinical_note", f"""
WITH j AS (SELECT row_number() OVER (ORDER BY e.encounter_datetime, e.encounter_id) AS consult_id,
    e.encounter_id, e.patient_id, e.visit_id, e.encounter_datetime, e.location_id, l.name AS encounter_location,
    k.name AS provider, trim(n.given_name) AS first_name, trim(n.family_name) AS last_name, p.birthdate, p.gender,
    r.encounter_id AS registration_encounter_id, rl.name AS registration_location_name,
    (SELECT arg_max(value_text, obs_id) FROM {_OBS} x WHERE x.encounter_id = r.encounter_id
      AND x.concept_id = {cid(values.POLICY_NUMBER)}) AS insurance_policy_number,
    v.encounter_id AS vitals_encounter_id, vm.* EXCLUDE (encounter_id), m.* EXCLUDE (encounter_id),
    coalesce(vm.vitals_glucose, m.consult_glucose) AS glucose_mg_dl, x.diagnoses, t.rapid_test_results, w.treatment
  FROM fx_encounter e JOIN (SELECT patient_id FROM {_LIVE}) q ON q.patient_id = e.patient_id
  LEFT JOIN (SELECT encounter_id, {measure_sql(values.NOTE_CONSULT)} FROM {_NAMED_OBS} o
    GROUP BY encounter_id) m ON m.encounter_id = e.encounter_id
  LEFT JOIN ({_VISIT_VITALS}) v ON v.visit_id = e.visit_id
  LEFT JOIN (SELECT encounter_id, {measure_sql(values.NOTE_VITALS)} FROM {_NAMED_OBS} o GROUP BY encounter_id) vm
    ON vm.encounter_id = v.encounter_id
  LEFT JOIN ({_DX_LIST}) x ON x.encounter_id = e.encounter_id
  LEFT JOIN (SELECT encounter_id, string_agg(display_name, ' ' ORDER BY obs_id) AS rapid_test_results
    FROM ({RAPID_SQL}) y GROUP BY encounter_id) t ON t.encounter_id = e.encounter_id
  LEFT JOIN ({_TREATMENT}) w ON w.encounter_id = e.encounter_id
  LEFT JOIN {_PERSON} p ON p.person_id = e.patient_id LEFT JOIN ({NAME_SQL}) n ON n.person_id = e.patient_id
  LEFT JOIN ({_PROVIDER}) k ON k.encounter_id = e.encounter_id
  LEFT JOIN fx_location l ON l.location_id = e.location_id
  LEFT JOIN ({_REGISTERED}) r ON r.patient_id = e.patient_id LEFT JOIN fx_location rl ON rl.location_id = r.location_id
  WHERE e.voided = 0 AND e.encounter_type = 1 AND {_IN_RANGE.format('e.encounter_datetime')}),
lines AS (SELECT *, 'Exploración Física: ' || physical_exam AS physical_exam_line,
    'Ultrasonido: ' || nullif(concat_ws(', ', ultrasound_type, ultrasound_notes), '') AS ultrasound_line,
    nullif(concat_ws(', ', 'Glucosa: ' || {number_sql('glucose_mg_dl')}, 'Ayuno: ' || glucose_fasting,
      'Hba1c: ' || {number_sql('hba1c')}, 'Proteinuria: ' || {number_sql('proteinuria')}), '') AS glucose_line,
    nullif(concat_ws(', ', 'Colesterol: ' || {number_sql('cholesterol')}, 'HDL: ' || {number_sql('hdl')},
      'LDL: ' || {number_sql('ldl')}), '') AS cholesterol_line FROM j)
SELECT consult_id, encounter_id, patient_id, visit_id, {_moment('encounter_datetime')} AS encounter_datetime,
  {_day_text('encounter_datetime')} AS encounter_date, strftime(encounter_datetime, '%H:%M') AS encounter_time,
  location_id, encounter_location,
  {_facility_case(values.NOTE_FACILITIES, 'encounter_location')} ELSE encounter_location END AS unidad_medica,
  provider, first_name, last_name, trim(first_name || ' ' || last_name) AS patient_name,
  {full_years_sql('birthdate', _day('encounter_datetime'))} AS age_years,
  {full_months_sql('birthdate', _day('encounter_datetime'))} % 12 AS age_months,
  CAST(date_diff('day', CAST(birthdate + to_months({full_months_sql('birthdate', _day('encounter_datetime'))}) AS DATE),
    {_day('encounter_datetime')}) AS INT) AS age_days,
  CAST(birthdate AS VARCHAR) AS birthdate, gender,
  CASE gender WHEN 'M' THEN 'MASCULINO' WHEN 'F' THEN 'FEMININO' END AS gender_display, registration_encounter_id,
  registration_location_name,
  {_facility_case(values.NOTE_FACILITIES, 'registration_location_name')} ELSE encounter_location END AS procedencia,
  insurance_policy_number, vitals_encounter_id, weight_kg, height_cm, height_cm / 100 AS height_m,
  {bmi_sql('weight_kg', 'height_cm')} AS bmi, {_WHOLE('systolic')} AS systolic, {_WHOLE('diastolic')} AS diastolic,
  {_WHOLE('heart_rate')} AS heart_rate, {_WHOLE('respiratory_rate')} AS respiratory_rate, temp_c, glucose_mg_dl,
  chief_complaint, waist_cm, 'S: ' || presenting_history AS subjective, analysis, physical_exam, physical_exam_line,
  ultrasound_type, ultrasound_notes, ultrasound_line, glucose_fasting, {number_sql('hba1c')} AS hba1c,
  {number_sql('proteinuria')} AS proteinuria, glucose_line, cholesterol, hdl, ldl, cholesterol_line,
  nullif(concat_ws(chr(10), physical_exam_line, ultrasound_line, glucose_line, cholesterol_line), '') AS test_results,
  diagnoses, plan, nullif(concat_ws(chr(10), 'Diagnóstico: ' || diagnoses, 'Indicaciones Médicas: ' || plan), '')
    AS diagnoses_and_plan, rapid_test_results, treatment,
  last_name || '-' || strftime(encounter_datetime, '%Y-%m-%d') || ' ' || encounter_id AS sheet_name
FROM lines
""")
def report_clinical_note(fx):
    return note.clinical_note(fx.clinic, START, END)


_CONTROLLED_DRUGS = f"""SELECT drug_id FROM fx_drug WHERE retired = 0 AND concept_id IN
  (SELECT concept_id FROM fx_concept_set WHERE concept_set = {cid(values.CONTROLLED_SET)})"""
_CONTROLLED_CONSULTS = f"""SELECT * FROM fx_encounter e WHERE voided = 0 AND encounter_type = 1
  AND {_IN_RANGE.format('encounter_datetime')} AND encounter_id IN (SELECT encounter_id FROM {_OBS} o
    WHERE concept_id = {cid(values.MEDICATION)} AND value_drug IN ({_CONTROLLED_DRUGS}))"""


@check("report_controlled_rx_encounters", f"""
WITH o AS (SELECT * FROM {_NAMED_OBS} x), d AS (SELECT encounter_id, string_agg(diagnosis, ', ' ORDER BY place, obs_id)
  AS diagnoses FROM (SELECT encounter_id, obs_id, CASE WHEN concept_id = {cid(values.DIAGNOSIS)} THEN name
      ELSE value_text END AS diagnosis, CASE WHEN obs_group_id IN (SELECT obs_group_id FROM o
        WHERE concept_id = {cid(values.DIAGNOSIS_ORDER)} AND value_coded = {cid(values.PRIMARY)}
          AND obs_group_id IS NOT NULL) THEN 0 ELSE 1 END AS place
    FROM o WHERE concept_id IN ({cid(values.DIAGNOSIS)}, {cid(values.DIAGNOSIS_TEXT)})) s GROUP BY encounter_id),
g AS (SELECT patient_id, string_agg(allergy, ', ' ORDER BY allergy) AS allergies FROM (SELECT DISTINCT a.patient_id,
    CASE WHEN a.coded_allergen = {cid(values.OTHER)} THEN a.non_coded_allergen ELSE n.name END AS allergy
  FROM fx_allergy a LEFT JOIN ({NAMES}) n ON n.concept_id = a.coded_allergen WHERE a.voided = 0) s GROUP BY patient_id)
SELECT e.encounter_id, e.patient_id, {_day_text('e.encounter_datetime')} AS encounter_date, k.name AS prescriber,
  trim(n.given_name || ' ' || n.family_name) AS patient_name, CAST(p.birthdate AS VARCHAR) AS birthdate,
  {full_years_sql('p.birthdate', _day('e.encounter_datetime'))} AS age, d.diagnoses, g.allergies,
  TRUE AS has_qualifying_prescription
FROM ({_CONTROLLED_CONSULTS}) e LEFT JOIN d ON d.encounter_id = e.encounter_id
LEFT JOIN g ON g.patient_id = e.patient_id LEFT JOIN ({_PROVIDER}) k ON k.encounter_id = e.encounter_id
LEFT JOIN {_PERSON} p ON p.person_id = e.patient_id LEFT JOIN ({NAME_SQL}) n ON n.person_id = e.patient_id
""")
def report_controlled_rx_encounters(fx):
    return prescriptions.controlled_encounters(fx.clinic, START, END)


@check("report_controlled_rx_meds", f"""
SELECT * FROM ({MEDICATION_SQL}) m WHERE encounter_id IN (SELECT encounter_id FROM ({_CONTROLLED_CONSULTS}) c)
""")
def report_controlled_rx_meds(fx):
    return prescriptions.controlled_meds(fx.clinic, START, END)


# --- reports of one patient, and options of the original queries ---------------


def _patient(fx, encounter_type: int) -> int:
    """A patient with an encounter of the type; -1 where there is none."""
    rows = active(fx.encounter).filter(F.col("encounter_type") == encounter_type)
    return rows.agg(F.coalesce(F.min("patient_id"), F.lit(-1))).first()[0]


@check("report_front_sheet_single_patient", _FRONT_SHEET.replace("@which", "patient_id = " + _PATIENT.format(1)))
def report_front_sheet_single_patient(fx):
    return registration.front_sheet(fx.clinic, patient_id=_patient(fx, 1))


@check("report_clinical_history_single_patient", _HISTORY.replace("@which", "e.patient_id = " + _PATIENT.format(4)).replace(
    _HISTORY_FINAL["sheet_name"], "strftime(encounter_datetime, '%Y-%m-%d') || ' ' || encounter_id"))
def report_clinical_history_single_patient(fx):
    """One patient's sheets are named without the surname."""
    return history.history(fx.clinic, patient_id=_patient(fx, 4))


_CONTROLLED_PATIENT = f"""(SELECT min(patient_id) FROM fx_encounter WHERE voided = 0 AND encounter_type = 1
  AND encounter_id IN (SELECT encounter_id FROM {_OBS} o WHERE concept_id = {cid(values.MEDICATION)}
    AND value_drug IN ({_CONTROLLED_DRUGS})))"""


@check("report_controlled_rx_meds_single_patient", f"""
SELECT * FROM ({MEDICATION_SQL}) m WHERE encounter_id IN (SELECT encounter_id FROM fx_encounter e WHERE voided = 0
  AND encounter_type = 1 AND patient_id = {_CONTROLLED_PATIENT} AND encounter_id IN (SELECT encounter_id FROM {_OBS} o
    WHERE concept_id = {cid(values.MEDICATION)} AND value_drug IN ({_CONTROLLED_DRUGS})))
""")
def report_controlled_rx_meds_single_patient(fx):
    whole = prescriptions.controlled_encounters(fx.clinic, None, None)
    patient = whole.agg(F.coalesce(F.min("patient_id"), F.lit(-1))).first()[0]
    return prescriptions.controlled_meds(fx.clinic, None, None, patient_id=patient)


@check("report_meds_stock_all_numeric", f"""
SELECT d.name AS "Medicamento", CAST(sum(q.value_numeric) AS DOUBLE) AS "Cantidad", l.name AS "Clinica"
FROM fx_drug d LEFT JOIN fx_clinic_obs n ON n.value_drug = d.drug_id AND {_IN_RANGE.format('n.obs_datetime')}
LEFT JOIN fx_location l ON l.location_id = n.location_id
LEFT JOIN fx_clinic_obs q ON q.obs_group_id = n.obs_group_id AND q.value_numeric IS NOT NULL
WHERE d.name LIKE 'SITE%' AND d.retired = 0 GROUP BY d.drug_id, d.name, l.location_id, l.name
""")
def report_meds_stock_all_numeric(fx):
    """As the original query: every numeric sibling counts, voided rows too."""
    return drugs.meds_stock(fx.clinic, START, END, name_prefix="SITE", include_voided=True, all_numeric=True)


@check("report_controlled_rx_meds_nested_sets", f"""
WITH RECURSIVE inside(concept) AS (SELECT {cid(values.CONTROLLED_SET)} UNION
  SELECT m.concept_id FROM fx_concept_set m JOIN inside i ON m.concept_set = i.concept)
SELECT * FROM ({MEDICATION_SQL}) m WHERE encounter_id IN (SELECT encounter_id FROM fx_encounter e WHERE voided = 0
  AND encounter_type = 1 AND {_IN_RANGE.format('encounter_datetime')} AND encounter_id IN (SELECT encounter_id FROM {_OBS} o
    WHERE concept_id = {cid(values.MEDICATION)} AND value_drug IN (SELECT drug_id FROM fx_drug WHERE retired = 0
      AND concept_id IN (SELECT concept FROM inside)))
)
""")
def report_controlled_rx_meds_nested_sets(fx):
    """Drugs of sets inside the controlled set count too."""
    return prescriptions.controlled_meds(fx.clinic, START, END, nested_sets=True)
