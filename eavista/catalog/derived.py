"""Checks of derived clinical values and row rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from eavista import values
from eavista.catalog.fixture import cid
from eavista.catalog.registry import check
from eavista.catalog.scalars import bmi_sql, born_and_seen, full_years_sql
from eavista.functions import ages, clinical
from eavista.operators.filters import active
from eavista.operators.latest import carry_forward
from eavista.operators.obs import Measure, pivot_obs
from eavista.session import literal_table


_BASELINE = """SELECT obs_id, person_id, obs_datetime, CASE WHEN obs_id % 5 = 0 THEN value END AS entered,
  value AS current FROM {fx_screening}"""


@check("calc_percent_reduction", f"""
WITH s AS ({_BASELINE.replace('{fx_screening}', 'fx_screening')}), b AS (SELECT *, last_value(entered IGNORE NULLS)
  OVER (PARTITION BY person_id ORDER BY obs_datetime, obs_id ROWS UNBOUNDED PRECEDING) AS baseline FROM s),
c AS (SELECT obs_id, nullif(CAST(trunc(baseline) AS BIGINT), 0) AS base, CAST(trunc(current) AS BIGINT) AS now FROM b)
SELECT obs_id, CAST(floor((base - now) / base * 100 + 0.5) AS BIGINT) AS reduction FROM c
""")
def calc_percent_reduction(fx):
    rows = carry_forward(fx.sql(_BASELINE), "person_id", "obs_datetime", "obs_id", "entered", "baseline")
    return rows.select("obs_id", clinical.percent_reduction(F.col("baseline"), F.col("current")).alias("reduction"))


_PREGNANCY = """SELECT base_id, CAST(l_shipdate AS DATE) AS lmp, e.encounter_datetime
FROM {fx_obs_base} b JOIN {fx_encounter} e ON e.encounter_id = b.encounter_id"""


@check("calc_gestational_age", f"""
SELECT base_id, CAST(days AS INT) AS gestational_days, CAST(floor(days / 7.0) AS INT) AS gestational_weeks,
  CAST(days % 7 AS INT) AS remainder_days, CAST(floor(days / 7.0) AS INT) || ' '
  || CASE WHEN days % 7 <> 0 THEN (days % 7) || '/7 ' ELSE ' ' END || 'semanas' AS gestational_text,
  CAST(CAST(lmp + 280 AS DATE) AS VARCHAR) AS due_date
FROM (SELECT *, date_diff('day', lmp, CAST(encounter_datetime AS DATE)) AS days
  FROM ({_PREGNANCY.replace('{fx_obs_base}', 'fx_obs_base').replace('{fx_encounter}', 'fx_encounter')}) p) s
""")
def calc_gestational_age(fx):
    rows = fx.sql(_PREGNANCY)
    parts = ages.gestational_age(F.col("lmp"), F.col("encounter_datetime"))
    return rows.select("base_id", *[c.alias(name) for name, c in parts.items()])


_SCORES = " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.ANSWER_SCORES.items())


@check("calc_questionnaire_score", f"""
SELECT person_id, strftime(obs_datetime, '%Y-%m-%d') AS day,
  CAST(coalesce(sum(CASE answer {_SCORES} END), 0) AS BIGINT) AS score, count(CASE answer {_SCORES} END) AS answered
FROM fx_screening GROUP BY 1, 2
""")
def calc_questionnaire_score(fx):
    """Sum of the answered items per person and day; other texts do not count, and no answer sums to 0."""
    score = clinical.answer_score(F.col("answer"))
    return fx.screening.groupBy("person_id", F.date_format("obs_datetime", "yyyy-MM-dd").alias("day")).agg(
        F.coalesce(F.sum(score), F.lit(0)).cast("bigint").alias("score"), F.count(score).alias("answered"))


_LMP = cid("968")


@check("calc_last_menstrual_fallback", f"""
WITH n AS (SELECT encounter_id, arg_max(value_datetime, obs_id) AS entered FROM fx_clinic_obs
  WHERE voided = 0 AND concept_id = {_LMP} GROUP BY encounter_id),
e AS (SELECT e.encounter_id, e.patient_id, e.encounter_datetime, n.entered FROM fx_encounter e
  LEFT JOIN n ON n.encounter_id = e.encounter_id WHERE e.voided = 0)
SELECT encounter_id, CAST(CAST(last_value(entered IGNORE NULLS) OVER (PARTITION BY patient_id
  ORDER BY encounter_datetime, encounter_id ROWS UNBOUNDED PRECEDING) AS DATE) AS VARCHAR) AS lmp FROM e
""")
def calc_last_menstrual_fallback(fx):
    """The date entered in the encounter, else the patient's last stored one."""
    entered = pivot_obs(active(fx.clinic["obs"]), "encounter_id", [Measure("entered", "968", "date")],
                        fx.clinic.dictionary)
    rows = active(fx.encounter).select("encounter_id", "patient_id", "encounter_datetime")
    rows = rows.join(entered, "encounter_id", "left")
    rows = carry_forward(rows, "patient_id", "encounter_datetime", "encounter_id", "entered", "lmp", "year")
    return rows.select("encounter_id", "lmp")


_GATED = {"weight": "WEIGHT (KG)", "height": "HEIGHT (CM)", "head": "HEAD CIRCUMFERENCE"}
_GATED_SQL = ", ".join(f"arg_max(value_numeric, obs_id) FILTER (WHERE concept_id = {cid(c)}) AS {k}"
                       for k, c in _GATED.items())


@check("rule_age_gated_measure", f"""
SELECT s.encounter_id, age, CASE WHEN age > 5 THEN {bmi_sql('weight', 'height')} END AS bmi,
  CASE WHEN age < 6 THEN head END AS head_circumference
FROM (SELECT e.encounter_id, {full_years_sql('p.birthdate', 'CAST(e.encounter_datetime AS DATE)')} AS age
  FROM fx_encounter e JOIN fx_person p ON p.person_id = e.patient_id) s
JOIN (SELECT encounter_id, {_GATED_SQL} FROM fx_clinic_obs WHERE voided = 0
  AND concept_id IN ({', '.join(str(cid(c)) for c in _GATED.values())}) GROUP BY encounter_id) m
  ON m.encounter_id = s.encounter_id
""")
def rule_age_gated_measure(fx):
    measured = pivot_obs(active(fx.clinic["obs"]), "encounter_id",
                         [Measure(k, code) for k, code in _GATED.items()], fx.clinic.dictionary)
    rows = born_and_seen(fx).join(measured, "encounter_id").withColumn(
        "age", ages.full_years(F.col("birthdate"), F.col("encounter_datetime")))
    age = F.col("age")
    return rows.select(
        "encounter_id", "age",
        clinical.bmi_if_old_enough(age, F.col("weight"), F.col("height")).alias("bmi"),
        clinical.head_circumference_if_young(age, F.col("head")).alias("head_circumference"))


_RULE_CODES = {"drug": (values.MEDICATION, "drug_id", "value_drug"), "dose": ("9073", "numeric", "value_numeric"),
               "dose_unit": ("Dosing units coded", "coded", "value_coded"),
               "frequency": ("Part of the day", "coded", "value_coded"),
               "duration": ("9075", "numeric", "value_numeric"),
               "duration_unit": ("TIME UNITS", "coded", "value_coded"), "instructions": ("9072", "text", "value_text")}
_RULE_SQL = ", ".join(f"arg_min({column}, obs_id) FILTER (WHERE concept_id = {cid(code)}) AS {k}"
                      for k, (code, _, column) in _RULE_CODES.items())


@check("rule_medication_row", f"""
SELECT * FROM (SELECT obs_group_id,
  drug IS NULL AND (dose IS NOT NULL OR dose_unit IS NOT NULL OR frequency IS NOT NULL OR duration IS NOT NULL
    OR duration_unit IS NOT NULL OR instructions IS NOT NULL) AS details_without_drug,
  dose IS NOT NULL AND dose_unit IS NULL AS dose_without_unit,
  dose IS NULL AND dose_unit IS NOT NULL AS unit_without_dose,
  duration IS NOT NULL AND duration_unit IS NULL AS duration_without_unit,
  duration IS NULL AND duration_unit IS NOT NULL AS unit_without_duration
FROM (SELECT obs_group_id, {_RULE_SQL} FROM fx_clinic_obs WHERE voided = 0 AND obs_group_id IS NOT NULL
  AND concept_id IN ({', '.join(str(cid(code)) for code, _, _ in _RULE_CODES.values())})
  GROUP BY obs_group_id) s) r
WHERE details_without_drug OR dose_without_unit OR unit_without_dose OR duration_without_unit
  OR unit_without_duration
""")
def rule_medication_row(fx):
    """Medication groups that break at least one rule, with the rules they break."""
    wanted = [Measure(k, code, kind, pick="first") for k, (code, kind, _) in _RULE_CODES.items()]
    rows = pivot_obs(active(fx.clinic["obs"]).filter("obs_group_id IS NOT NULL"), "obs_group_id", wanted,
                     fx.clinic.dictionary)
    flags = clinical.medication_violations(*[F.col(k) for k in _RULE_CODES])
    flagged = rows.select("obs_group_id", *[c.alias(k) for k, c in flags.items()])
    return flagged.filter(" OR ".join(flags))


# the programs' exit box and outcome stand on pairs of coded answers of the fixture
_EXITS = dict(zip(values.EXIT_PROGRAMS, range(6)))


@check("rule_exit_requires_outcome", f"""
SELECT encounter_id, concat_ws(', ', {', '.join(
    f"CASE WHEN max(CASE WHEN slot = {2 * i} THEN 1 END) = 1 AND max(CASE WHEN slot = {2 * i + 1} THEN 1 END) IS NULL "
    f"THEN '{p}' END" for p, i in _EXITS.items())}) AS missing_outcomes
FROM (SELECT encounter_id, concept_id - 3001 AS slot FROM fx_clinic_obs WHERE voided = 0
  AND concept_id BETWEEN 3001 AND 3012) s
GROUP BY encounter_id HAVING missing_outcomes <> ''
""")
def rule_exit_requires_outcome(fx):
    """Encounters that leave a program without an outcome, with the programs."""
    wanted = [Measure(f"{p}_{part}", 3001 + 2 * i + n, "coded")
              for p, i in _EXITS.items() for n, part in enumerate(("exit", "outcome"))]
    rows = pivot_obs(active(fx.clinic["obs"]), "encounter_id", wanted)
    exits = {p: (F.col(f"{p}_exit").isNotNull(), F.col(f"{p}_outcome")) for p in _EXITS}
    missing = F.array_join(clinical.exit_without_outcome(exits), ", ")
    return rows.select("encounter_id", missing.alias("missing_outcomes")).filter("missing_outcomes <> ''")


_FASTING = "Fasting for blood glucose test"
_ALLOWED = [(values.CIVIL_STATUS, a) for a in (values.YES, "NO", "Unknown")] + [
    (_FASTING, a) for a in values.FASTING_ANSWERS]


@check("rule_allowed_answers", f"""
SELECT obs_id, concept_id, value_coded FROM fx_clinic_obs WHERE voided = 0 AND value_coded IS NOT NULL
  AND concept_id IN ({', '.join(str(cid(q)) for q, _ in _ALLOWED)})
  AND (concept_id, value_coded) NOT IN ({', '.join(f'({cid(q)}, {cid(a)})' for q, a in _ALLOWED)})
""")
def rule_allowed_answers(fx):
    """Coded answers that are not on the list of their question."""
    dictionary = fx.clinic.dictionary
    questions = {q: q for q, _ in _ALLOWED}
    rows = dictionary.only_role(active(fx.clinic["obs"]), "concept_id", questions, "question")
    rows = dictionary.with_role(rows.filter("value_coded IS NOT NULL"), "value_coded",
                                {a: a for _, a in _ALLOWED}, "answer")
    allowed = literal_table(fx.spark, "question string, answer string", _ALLOWED)
    return rows.join(F.broadcast(allowed), ["question", "answer"], "left_anti").select(
        "obs_id", "concept_id", "value_coded")
