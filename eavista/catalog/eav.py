"""Checks of the observation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from eavista import values
from eavista.catalog.fixture import cid
from eavista.catalog.registry import check
from eavista.operators.filters import active
from eavista.operators.obs import (
    Measure, measures, medication_lines, narrow_obs, ordered_list, pivot_obs, rapid_test_lines,
)

# the name a report shows for a concept: the preferred one of the locale, else another
NAMES = """SELECT concept_id, coalesce(
    max(name) FILTER (WHERE locale = 'es' AND locale_preferred = 1 AND concept_name_type <> 'SHORT'),
    max(name) FILTER (WHERE locale = 'en' AND concept_name_type <> 'SHORT')) AS name,
  max(name) FILTER (WHERE concept_name_type = 'SHORT') AS short_name
FROM fx_concept_name WHERE voided = 0 GROUP BY concept_id"""


def pick(code: str, column: str, how: str = "arg_max", answer: str | None = None) -> str:
    """The newest (or first) value of a concept, as an aggregate of the check SQL."""
    extra = f" AND value_coded = {cid(answer)}" if answer else ""
    return f"{how}({column}, obs_id) FILTER (WHERE concept_id = {cid(code)}{extra})"


def listed(code: str, separator: str = " | ", name: str = "name") -> str:
    return f"string_agg({name}, '{separator}' ORDER BY obs_id) FILTER (WHERE concept_id = {cid(code)})"


SQL_VALUES = {"numeric": "value_numeric", "text": "value_text"}


def measure_sql(rows: tuple) -> str:
    """The columns of a fixed measure table, in check SQL (names joined as ``name``)."""
    out = []
    for column, code, kind in rows:
        if kind == "coded_list":
            out.append(f"{listed(code)} AS {column}")
        elif kind == "date":
            out.append(f"CAST(CAST({pick(code, 'value_datetime')} AS DATE) AS VARCHAR) AS {column}")
        else:
            out.append(f"{pick(code, SQL_VALUES[kind])} AS {column}")
    return ",\n  ".join(out)


@check("obs_narrow", """
SELECT o.obs_id, o.concept_id FROM fx_clinic_obs o WHERE o.voided = 0
  AND o.encounter_id IN (SELECT encounter_id FROM fx_encounter WHERE voided = 0 AND encounter_type = 2)
""")
def obs_narrow(fx):
    keys = fx.clinic.encounters(values.VITALS)
    rows = narrow_obs(fx.clinic["obs"], keys)
    return rows.select("obs_id", "concept_id")


@check("obs_value_numeric", """
SELECT encounter_id, arg_max(value_numeric, obs_id) FILTER (WHERE concept_id = 101) AS quantity,
  arg_max(value_numeric, obs_id) FILTER (WHERE concept_id = 102) AS price
FROM fx_obs WHERE voided = 0 GROUP BY encounter_id
""")
def obs_value_numeric(fx):
    return pivot_obs(active(fx.obs), "encounter_id", [Measure("quantity", 101), Measure("price", 102)])


@check("obs_value_text", """
SELECT encounter_id, arg_max(value_text, obs_id) AS note FROM fx_obs
WHERE voided = 0 AND concept_id = 107 GROUP BY encounter_id
""")
def obs_value_text(fx):
    return pivot_obs(active(fx.obs), "encounter_id", [Measure("note", 107, "text")])


@check("obs_value_datetime", """
SELECT encounter_id, CAST(CAST(arg_max(value_datetime, obs_id) AS DATE) AS VARCHAR) AS day
FROM fx_obs WHERE voided = 0 AND concept_id = 105 GROUP BY encounter_id
""")
def obs_value_datetime(fx):
    return pivot_obs(active(fx.obs), "encounter_id", [Measure("day", 105, "date")])


_SIMPLE_NAMES = "SELECT DISTINCT concept_id, name FROM fx_simple_concept"


@check("obs_value_coded_list", f"""
SELECT encounter_id, string_agg(n.name, ' | ' ORDER BY obs_id) FILTER (WHERE o.concept_id = 103) AS diagnoses,
  string_agg(n.name, ', ' ORDER BY obs_id) FILTER (WHERE o.concept_id = 104) AS certainties
FROM fx_obs o LEFT JOIN ({_SIMPLE_NAMES}) n ON n.concept_id = o.value_coded
WHERE o.voided = 0 AND o.concept_id IN (103, 104) GROUP BY encounter_id
""")
def obs_value_coded_list(fx):
    names = fx.simple_concept.select("concept_id", "name").distinct()
    wanted = [Measure("diagnoses", 103, "coded_list"),
              Measure("certainties", 104, "coded_list", separator=", ")]
    return pivot_obs(active(fx.obs), "encounter_id", wanted, names=names)


@check("obs_group_value_text", """
SELECT obs_group_id, arg_max(value_text, obs_id) AS note FROM fx_obs
WHERE voided = 0 AND concept_id = 107 GROUP BY obs_group_id
""")
def obs_group_value_text(fx):
    return pivot_obs(active(fx.obs), "obs_group_id", [Measure("note", 107, "text")])


@check("obs_group_value_coded_list", f"""
SELECT obs_group_id, string_agg(n.name, ' | ' ORDER BY obs_id) AS diagnoses
FROM fx_obs o LEFT JOIN ({_SIMPLE_NAMES}) n ON n.concept_id = o.value_coded
WHERE o.voided = 0 AND o.concept_id = 103 GROUP BY obs_group_id
""")
def obs_group_value_coded_list(fx):
    names = fx.simple_concept.select("concept_id", "name").distinct()
    return pivot_obs(active(fx.obs), "obs_group_id", [Measure("diagnoses", 103, "coded_list")], names=names)


_TIMING = "Part of the day"


@check("obs_comment_by_coded", f"""
SELECT obs_group_id, {pick(_TIMING, 'comments', 'arg_min', values.PARTS_OF_DAY['morning'])} AS morning,
  {pick(_TIMING, 'comments', 'arg_min', values.PARTS_OF_DAY['evening'])} AS evening
FROM fx_clinic_obs WHERE voided = 0 AND concept_id = {cid(_TIMING)} GROUP BY obs_group_id
""")
def obs_comment_by_coded(fx):
    wanted = [Measure(part, _TIMING, "comment", values.PARTS_OF_DAY[part], "first")
              for part in ("morning", "evening")]
    return pivot_obs(active(fx.clinic["obs"]), "obs_group_id", wanted, fx.clinic.dictionary)


_VITALS_IDS = ", ".join(str(cid(c)) for _, c, _ in values.VITALS_MEASURES)


@check("obs_pivot_wide", f"""
SELECT encounter_id, {measure_sql(values.VITALS_MEASURES)}
FROM (SELECT o.*, n.name FROM fx_clinic_obs o LEFT JOIN ({NAMES}) n ON n.concept_id = o.value_coded
      WHERE o.voided = 0 AND o.concept_id IN ({_VITALS_IDS})) s GROUP BY encounter_id
""")
def obs_pivot_wide(fx):
    """All vitals columns of every encounter from one aggregation."""
    return pivot_obs(active(fx.clinic["obs"]), "encounter_id", measures(values.VITALS_MEASURES),
                     fx.clinic.dictionary)


@check("obs_pivot_bucketed", f"""
SELECT encounter_id, {measure_sql(values.VITALS_MEASURES)}
FROM (SELECT o.*, n.name FROM fx_clinic_obs o LEFT JOIN ({NAMES}) n ON n.concept_id = o.value_coded
      WHERE o.voided = 0 AND o.concept_id IN ({_VITALS_IDS}) AND o.encounter_id IN (
        SELECT encounter_id FROM fx_encounter WHERE voided = 0
          AND encounter_datetime >= TIMESTAMP '1996-01-01' AND encounter_datetime < TIMESTAMP '1997-01-01')) s
GROUP BY encounter_id
""")
def obs_pivot_bucketed(fx):
    """The vitals of one year's encounters, joined and pivoted in the buckets of a stored table."""
    year = fx.clinic.encounters(None, "1996-01-01", "1996-12-31")
    codes = [code for _, code, _ in values.VITALS_MEASURES]
    rows = narrow_obs(fx.bucketed_obs(), year, codes=codes, dictionary=fx.clinic.dictionary)
    return pivot_obs(rows, "encounter_id", measures(values.VITALS_MEASURES), fx.clinic.dictionary)


@check("obs_to_date_of_group", f"""
SELECT encounter_id, arg_max(obs_group_id, obs_id) AS insurance_group FROM fx_clinic_obs
WHERE voided = 0 AND concept_id = {cid(values.INSURANCE)} AND value_coded = {cid(values.POPULAR_INSURANCE)}
GROUP BY encounter_id
""")
def obs_to_date_of_group(fx):
    """The group of the newest insurance observation with a given answer."""
    dictionary = fx.clinic.dictionary
    rows = dictionary.only_role(active(fx.clinic["obs"]), "concept_id", {"q": values.INSURANCE}, "_role")
    rows = rows.filter(F.col("value_coded") == dictionary.concept(values.POPULAR_INSURANCE))
    return rows.groupBy("encounter_id").agg(F.max_by("obs_group_id", "obs_id").alias("insurance_group"))


_TEST_LABELS = " ".join(f"WHEN {cid(c)} THEN '{label}'" for c, label in values.RAPID_TESTS.items())
_SUSPECT = ", ".join(str(cid(c)) for c in values.SUSPICIONS)
RAPID_SQL = f"""SELECT encounter_id, obs_id, display_name FROM (
  SELECT o.encounter_id, o.obs_id, CASE
      WHEN o.concept_id IN ({_SUSPECT}) AND o.value_coded = {cid(values.YES_SHARED)} THEN label
      WHEN o.concept_id = {cid(values.BLOOD_TYPING)} THEN label || ': ' || n.name
      WHEN o.value_coded = {cid(values.NEGATIVE)} THEN label || ' negativo'
      WHEN o.value_coded = {cid(values.POSITIVE)} THEN label || ' positivo' END AS display_name
  FROM (SELECT *, CASE concept_id {_TEST_LABELS} END AS label FROM fx_clinic_obs
        WHERE voided = 0 AND concept_id BETWEEN 6001 AND 6010) o
  LEFT JOIN ({NAMES}) n ON n.concept_id = o.value_coded) s WHERE display_name IS NOT NULL"""


@check("obs_rapid_test_labels", f"""
SELECT encounter_id, string_agg(display_name, ' ' ORDER BY obs_id) AS rapid_test_results
FROM ({RAPID_SQL}) t GROUP BY encounter_id
""")
def obs_rapid_test_labels(fx):
    lines = rapid_test_lines(active(fx.clinic["obs"]), fx.clinic.dictionary)
    return lines.groupBy("encounter_id").agg(
        ordered_list("display_name", " ", "obs_id").alias("rapid_test_results"))


def _medication_columns() -> str:
    columns = {"numeric": "value_numeric", "text": "value_text", "comment": "comments",
               "drug": "drug", "coded_name": "name", "coded_short_name": "short_name"}
    return ",\n  ".join(
        f"{pick(code, columns[kind], 'arg_min', values.PARTS_OF_DAY.get(part))} AS {column}"
        for column, code, kind, part in values.MEDICATION_MEASURES
    )


MEDICATION_SQL = f"""SELECT p.encounter_id, p.obs_id AS obs_group_id, m.* EXCLUDE (obs_group_id)
FROM fx_clinic_obs p LEFT JOIN (
  SELECT obs_group_id, {_medication_columns()}
  FROM (SELECT o.*, n.name, n.short_name, d.name AS drug FROM fx_clinic_obs o
        LEFT JOIN ({NAMES}) n ON n.concept_id = o.value_coded
        LEFT JOIN fx_drug d ON d.drug_id = o.value_drug WHERE o.voided = 0) c
  WHERE obs_group_id IS NOT NULL GROUP BY obs_group_id) m ON m.obs_group_id = p.obs_id
WHERE p.voided = 0 AND p.concept_id = {cid(values.MEDICATION_GROUP)}"""


@check("obs_medication_regimen", MEDICATION_SQL)
def obs_medication_regimen(fx):
    return medication_lines(active(fx.clinic["obs"]), fx.clinic.dictionary, fx.clinic["drug"])
