"""Checks of aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from eavista import values
from eavista.catalog.fixture import CONCEPT_IDS
from eavista.catalog.registry import check
from eavista.operators.filters import active
from eavista.operators.obs import group_totals, latest_marked_group, ordered_list
from eavista.plans import prescriptions


_GIVEN_SQL = """FROM fx_obs o JOIN fx_obs q ON q.obs_group_id = o.obs_group_id AND q.concept_id = 101 AND q.voided = 0
JOIN fx_encounter e ON e.encounter_id = o.encounter_id"""


def _given(fx):
    """Live drug observations with the quantity of their group and the encounter's place."""
    obs = active(fx.obs)
    totals = group_totals(obs.filter("concept_id = 101"), "quantity")
    drugs = obs.filter("value_drug IS NOT NULL").select("obs_id", "obs_group_id", "encounter_id", "value_drug")
    places = fx.encounter.select("encounter_id", "location_id")
    return drugs.join(totals, "obs_group_id").join(places, "encounter_id")


@check("agg_sum_by_group", f"""
SELECT o.value_drug, e.location_id, CAST(sum(q.value_numeric) AS DOUBLE) AS quantity
{_GIVEN_SQL} WHERE o.value_drug IS NOT NULL AND o.voided = 0 GROUP BY 1, 2
""")
def agg_sum_by_group(fx):
    return _given(fx).groupBy("value_drug", "location_id").agg(F.sum("quantity").cast("double").alias("quantity"))


@check("agg_sum_any_value", f"""
SELECT o.value_drug AS drug_id, CAST(sum(q.value_numeric) AS DOUBLE) AS quantity, min(l.name) AS clinic
{_GIVEN_SQL} LEFT JOIN fx_location l ON l.location_id = e.location_id
WHERE o.value_drug IS NOT NULL AND o.voided = 0 GROUP BY 1
""")
def agg_sum_any_value(fx):
    """The non-grouped name is made explicit: the first one."""
    rows = fx.clinic.with_location(_given(fx), "location_id", "_clinic", "obs_id")
    return rows.groupBy(F.col("value_drug").alias("drug_id")).agg(
        F.sum("quantity").cast("double").alias("quantity"), F.min("_clinic").alias("clinic"))


@check("agg_max_label", """
SELECT concept_id, max(name) AS label FROM fx_concept_name WHERE voided = 0 AND locale = 'es' GROUP BY concept_id
""")
def agg_max_label(fx):
    names = active(fx.concept_name).filter("locale = 'es'")
    return names.groupBy("concept_id").agg(F.max("name").alias("label"))


@check("agg_count", "SELECT count(*) AS row_count FROM fx_obs WHERE voided = 1 AND value_coded = 203")
def agg_count(fx):
    return fx.obs.filter("voided = 1 AND value_coded = 203").agg(F.count("*").alias("row_count"))


@check("agg_distinct_keys", """
SELECT DISTINCT encounter_id, obs_group_id FROM fx_obs WHERE value_coded = 202 AND voided = 0
""")
def agg_distinct_keys(fx):
    return active(fx.obs).filter("value_coded = 202").select("encounter_id", "obs_group_id").distinct()


@check("agg_string_list", """
SELECT encounter_id, string_agg(value_text, ' | ' ORDER BY obs_id) AS notes FROM fx_obs
WHERE voided = 0 GROUP BY encounter_id
""")
def agg_string_list(fx):
    """Nulls are skipped; an encounter without texts gives null."""
    return active(fx.obs).groupBy("encounter_id").agg(
        ordered_list("value_text", values.LIST_SEPARATOR, "obs_id").alias("notes"))


@check("agg_ordered_string_list", f"""
WITH o AS (SELECT * FROM fx_clinic_obs WHERE voided = 0),
n AS (SELECT concept_id, coalesce(max(name) FILTER (WHERE locale = 'es' AND locale_preferred = 1),
  max(name) FILTER (WHERE locale = 'en')) AS name FROM fx_concept_name
  WHERE concept_name_type <> 'SHORT' GROUP BY concept_id),
d AS (SELECT o.encounter_id, o.obs_id, coalesce(n.name, o.value_text) AS diagnosis,
    CASE WHEN EXISTS (SELECT 1 FROM o p WHERE p.obs_group_id = o.obs_group_id
      AND p.concept_id = {CONCEPT_IDS[values.DIAGNOSIS_ORDER]}
      AND p.value_coded = {CONCEPT_IDS[values.PRIMARY]}) THEN 0 ELSE 1 END AS sort_order
  FROM o LEFT JOIN n ON n.concept_id = o.value_coded
  WHERE o.concept_id IN ({CONCEPT_IDS[values.DIAGNOSIS]}, {CONCEPT_IDS[values.DIAGNOSIS_TEXT]}))
SELECT encounter_id, string_agg(diagnosis, ', ' ORDER BY sort_order, obs_id) AS diagnoses FROM d
GROUP BY encounter_id
""")
def agg_ordered_string_list(fx):
    """Diagnoses of an encounter, primary ones first."""
    rows = prescriptions.all_diagnoses(fx.clinic, active(fx.clinic["obs"]))
    return rows.groupBy("encounter_id").agg(
        ordered_list("diagnosis", ", ", "sort_order", "obs_id").alias("diagnoses"))


@check("agg_group_dedup", f"""
SELECT patient_id, string_agg(allergy, ', ' ORDER BY allergy) AS allergies FROM (
  SELECT DISTINCT a.patient_id, CASE WHEN a.coded_allergen = {CONCEPT_IDS[values.OTHER]}
    THEN a.non_coded_allergen ELSE coalesce(
      (SELECT max(name) FROM fx_concept_name n WHERE n.concept_id = a.coded_allergen AND locale = 'es'
         AND locale_preferred = 1 AND concept_name_type <> 'SHORT'),
      (SELECT max(name) FROM fx_concept_name n WHERE n.concept_id = a.coded_allergen AND locale = 'en'
         AND concept_name_type <> 'SHORT')) END AS allergy
  FROM fx_allergy a WHERE a.voided = 0) s GROUP BY patient_id
""")
def agg_group_dedup(fx):
    """Each displayed allergy once per patient."""
    return prescriptions.allergy_lists(fx.clinic)


@check("agg_latest_then_group", f"""
WITH o AS (SELECT * FROM fx_clinic_obs WHERE voided = 0),
d AS (SELECT encounter_id, obs_group_id, value_datetime FROM o
  WHERE concept_id = {CONCEPT_IDS[values.PROCEDURE_DATE]} AND obs_group_id IN
    (SELECT obs_group_id FROM o WHERE value_coded = {CONCEPT_IDS[values.PAP_SMEAR]})),
m AS (SELECT encounter_id, max(value_datetime) AS at FROM d GROUP BY encounter_id)
SELECT m.encounter_id, CAST(CAST(m.at AS DATE) AS VARCHAR) AS date, max(d.obs_group_id) AS "group"
FROM m JOIN d ON d.encounter_id = m.encounter_id AND d.value_datetime = m.at GROUP BY 1, 2
""")
def agg_latest_then_group(fx):
    dictionary = fx.clinic.dictionary
    return latest_marked_group(
        active(fx.clinic["obs"]),
        F.col("value_coded") == dictionary.concept(values.PAP_SMEAR),
        F.col("concept_id") == dictionary.concept(values.PROCEDURE_DATE),
    )


@check("agg_group_collapse_null_key", """
SELECT visit_id, CASE WHEN visit_id IS NULL THEN encounter_id END AS loose_encounter_id,
  count(*) AS encounters FROM fx_encounter WHERE voided = 0 GROUP BY 1, 2
""")
def agg_group_collapse_null_key(fx):
    """Encounters without a visit are groups of their own instead of one group."""
    loose = F.when(F.col("visit_id").isNull(), F.col("encounter_id"))
    return active(fx.encounter).groupBy("visit_id", loose.alias("loose_encounter_id")).agg(
        F.count("*").alias("encounters"))
