"""Checks of joins, latest-per-key picks and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from eavista import values
from eavista.catalog.fixture import CONCEPT_IDS
from eavista.catalog.registry import ADDRESS_SQL, check
from eavista.operators import joins, lookups
from eavista.operators.filters import active
from eavista.operators.latest import number_rows
from eavista.operators.obs import Measure, group_totals, ordered_list, pivot_obs
from eavista.plans import prescriptions
from eavista.plans.history import latest_vitals_in_visit
from eavista.plans.registration import latest_registration


@check("join_inner_equi", """
SELECT o.obs_id, e.patient_id FROM fx_obs o JOIN fx_encounter e ON e.encounter_id = o.encounter_id
JOIN fx_patient p ON p.patient_id = e.patient_id
WHERE o.voided = 0 AND e.voided = 0 AND p.voided = 0 AND o.concept_id = 103
""")
def join_inner_equi(fx):
    coded = active(fx.obs).filter("concept_id = 103").select("obs_id", "encounter_id")
    kept = active(fx.encounter).join(active(fx.patient), "patient_id").select("encounter_id", "patient_id")
    return coded.join(kept, "encounter_id").select("obs_id", "patient_id")


@check("join_comma_to_equi", """
SELECT m.concept_id, s.name AS source, t.code
FROM fx_reference_map m, fx_reference_term t, fx_reference_source s
WHERE m.concept_reference_term_id = t.concept_reference_term_id
  AND t.concept_source_id = s.concept_source_id AND t.retired = 0 AND s.retired = 0
""")
def join_comma_to_equi(fx):
    return lookups.concept_mapping(fx.reference_map, fx.reference_term, fx.reference_source)


@check("join_left_filtered_on", """
SELECT d.drug_id, o.obs_id FROM fx_drug d LEFT JOIN fx_obs o ON o.value_drug = d.drug_id
  AND CAST(o.obs_datetime AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-02-28'
""")
def join_left_filtered_on(fx):
    """Drugs without a use in the period stay, with a null."""
    used = fx.obs.filter(
        "value_drug IS NOT NULL AND obs_datetime >= TIMESTAMP_NTZ '1996-01-01' "
        "AND obs_datetime < TIMESTAMP_NTZ '1996-02-29'"
    ).select(F.col("value_drug").alias("drug_id"), "obs_id")
    return fx.drug.select("drug_id").join(used, "drug_id", "left")


@check("join_group_self", """
SELECT d.obs_id, d.value_drug, sum(q.value_numeric) AS quantity, count(q.obs_id) > 0 AS has_quantity
FROM fx_obs d LEFT JOIN fx_obs q
  ON q.obs_group_id = d.obs_group_id AND q.concept_id = 101 AND q.voided = 0
WHERE d.concept_id = 106 AND d.voided = 0 GROUP BY d.obs_id, d.value_drug
""")
def join_group_self(fx):
    """Drug with the quantity of its group; the group is summed before the join."""
    drugs = active(fx.obs).filter("concept_id = 106").select("obs_id", "obs_group_id", "value_drug")
    totals = group_totals(active(fx.obs).filter("concept_id = 101"), "quantity")
    rows = joins.left_lookup(drugs, totals.withColumnRenamed("obs_group_id", "_g"), "obs_group_id",
                             "_g", "obs_id")
    return rows.select("obs_id", "value_drug", F.col("quantity").cast("double").alias("quantity"),
                       F.col("quantity").isNotNull().alias("has_quantity"))


_PARENT = CONCEPT_IDS[values.MEDICATION_GROUP]


@check("join_parent_child_obs", f"""
SELECT p.obs_id AS parent_id, count(c.obs_id) AS children, min(c.value_text) AS instructions
FROM fx_clinic_obs p LEFT JOIN fx_clinic_obs c ON c.obs_group_id = p.obs_id AND c.voided = 0
WHERE p.concept_id = {_PARENT} AND p.voided = 0 GROUP BY p.obs_id
""")
def join_parent_child_obs(fx):
    live = active(fx.clinic["obs"])
    parents = live.filter(F.col("concept_id") == _PARENT).select(F.col("obs_id").alias("parent_id"))
    children = live.filter("obs_group_id IS NOT NULL").groupBy(
        F.col("obs_group_id").alias("parent_id")
    ).agg(F.count("*").alias("children"), F.min("value_text").alias("instructions"))
    joined = parents.join(children, "parent_id", "left")
    return joined.select("parent_id", F.coalesce("children", F.lit(0)).alias("children"), "instructions")


_DX, _DX_TEXT = CONCEPT_IDS[values.DIAGNOSIS], CONCEPT_IDS[values.DIAGNOSIS_TEXT]


@check("join_or_condition", f"""
WITH o AS (SELECT obs_id, obs_group_id, concept_id FROM fx_clinic_obs WHERE voided = 0),
t AS (SELECT obs_id, obs_group_id FROM o WHERE concept_id IN ({_DX}, {_DX_TEXT})),
found AS (
  SELECT obs_id FROM o WHERE obs_group_id IN (SELECT obs_group_id FROM t WHERE obs_group_id IS NOT NULL)
  UNION SELECT obs_id FROM t)
SELECT obs_id, concept_id FROM o WHERE obs_id IN (SELECT obs_id FROM found)
""")
def join_or_condition(fx):
    live = active(fx.clinic["obs"]).select("obs_id", "obs_group_id", "concept_id")
    seeds = live.filter(F.col("concept_id").isin(_DX, _DX_TEXT))
    return joins.related_obs(live, seeds).select("obs_id", "concept_id")


@check("join_previous_event_theta", """
SELECT d.obs_id, NOT EXISTS (SELECT 1 FROM fx_clinic_obs p WHERE p.voided = 0
  AND p.person_id = d.person_id AND p.value_coded = d.value_coded AND p.date_created < d.date_created)
  AS first_time FROM fx_clinic_obs d WHERE d.voided = 0 AND d.value_coded >= 8001
""")
def join_previous_event_theta(fx):
    coded = active(fx.clinic["obs"]).select("obs_id", "person_id", "value_coded", "date_created")
    rows = coded.filter("value_coded >= 8001")
    flagged = joins.with_first_time_flag(rows, coded, ["person_id", "value_coded"], "date_created",
                                         "first_time")
    return flagged.select("obs_id", "first_time")


@check("join_previous_visit_same_year", """
SELECT v.visit_id, EXISTS (SELECT 1 FROM fx_visit p WHERE p.patient_id = v.patient_id
  AND p.date_stopped < v.date_started AND year(p.date_started) = year(v.date_started)) AS seen_before
FROM fx_visit v
""")
def join_previous_visit_same_year(fx):
    flagged = joins.with_earlier_visit_flag(fx.visit, fx.visit, "seen_before")
    return flagged.select("visit_id", "seen_before")


@check("join_latest_per_key", """
SELECT p.person_id, n.person_name_id, n.family_name FROM fx_person p
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY person_id
    ORDER BY preferred DESC, date_created DESC, person_name_id DESC) AS place
  FROM fx_person_name WHERE voided = 0) n ON n.person_id = p.person_id AND n.place = 1
""")
def join_latest_per_key(fx):
    names = lookups.latest_names(fx.person_name).select("person_id", "person_name_id", "family_name")
    return fx.person.select("person_id").join(names, "person_id", "left")


@check("join_latest_in_visit", """
SELECT c.encounter_id, v.encounter_id AS vitals_encounter_id FROM fx_encounter c
LEFT JOIN (SELECT encounter_id, visit_id, row_number() OVER (PARTITION BY visit_id
    ORDER BY encounter_datetime DESC, encounter_id DESC) AS place
  FROM fx_encounter WHERE voided = 0 AND encounter_type = 2) v
  ON v.visit_id = c.visit_id AND v.place = 1 WHERE c.voided = 0 AND c.encounter_type = 1
""")
def join_latest_in_visit(fx):
    consults = fx.clinic.encounters(values.CONSULT).select("encounter_id", "visit_id")
    latest = latest_vitals_in_visit(fx.clinic, consults).withColumnRenamed("visit_id", "_visit")
    rows = joins.left_lookup(consults, latest, "visit_id", "_visit", "encounter_id")
    return rows.select("encounter_id", "vitals_encounter_id")


@check("join_latest_registration", """
SELECT patient_id, encounter_id AS registration_encounter_id FROM (SELECT *, row_number() OVER
  (PARTITION BY patient_id ORDER BY encounter_datetime DESC, encounter_id DESC) AS place
  FROM fx_encounter WHERE voided = 0 AND encounter_type = 3) s WHERE place = 1
""")
def join_latest_registration(fx):
    return latest_registration(fx.clinic).select("patient_id", "registration_encounter_id")


@check("join_scalar_lookup", """
SELECT obs_id FROM fx_clinic_obs WHERE voided = 0 AND concept_id = (SELECT concept_id
  FROM fx_concept_mapping WHERE source = 'CIEL' AND lower(code) = lower('1443'))
""")
def join_scalar_lookup(fx):
    """The code's concept id is a scalar subquery that reaches the scan filter."""
    rows = active(fx.clinic["obs"])
    wanted = fx.clinic.dictionary.concept(values.DISPENSED_QUANTITY)
    return rows.filter(F.col("concept_id") == wanted).select("obs_id")


@check("join_aggregated_subquery", """
SELECT e.encounter_id, n.notes FROM fx_encounter e LEFT JOIN (SELECT encounter_id,
  string_agg(value_text, ', ' ORDER BY obs_id) AS notes FROM fx_obs WHERE voided = 0 GROUP BY encounter_id) n
  ON n.encounter_id = e.encounter_id
""")
def join_aggregated_subquery(fx):
    notes = active(fx.obs).filter("value_text IS NOT NULL").groupBy("encounter_id").agg(
        ordered_list("value_text", ", ", "obs_id").alias("notes"))
    return fx.encounter.select("encounter_id").join(notes, "encounter_id", "left")


_CONTROLLED = CONCEPT_IDS[values.CONTROLLED_SET]


@check("semi_join_qualifying", f"""
SELECT encounter_id FROM fx_encounter e WHERE e.voided = 0 AND EXISTS (SELECT 1 FROM fx_obs o
  JOIN fx_drug d ON d.drug_id = o.value_drug AND d.retired = 0
  JOIN fx_concept_set s ON s.concept_id = d.concept_id AND s.concept_set = {_CONTROLLED}
  WHERE o.encounter_id = e.encounter_id AND o.voided = 0)
""")
def semi_join_qualifying(fx):
    drugs = prescriptions.controlled_drugs(fx.clinic).select("drug_id")
    uses = active(fx.obs).select("encounter_id", F.col("value_drug").alias("drug_id"))
    uses = uses.join(drugs, "drug_id", "left_semi")
    return active(fx.encounter).join(uses, "encounter_id", "left_semi").select("encounter_id")


@check("semi_join_in", """
SELECT obs_id FROM fx_obs WHERE encounter_id IN
  (SELECT encounter_id FROM fx_encounter WHERE encounter_type = 5 AND voided = 0)
""")
def semi_join_in(fx):
    """The few ids are hashed, part by part: the many observations then need no sort."""
    keys = active(fx.encounter).filter("encounter_type = 5").select("encounter_id")
    return fx.obs.join(keys.hint("shuffle_hash"), "encounter_id", "left_semi").select("obs_id")


@check("anti_join_not_in", """
SELECT encounter_id FROM fx_encounter WHERE patient_id NOT IN (SELECT person_id FROM fx_person_attribute
  WHERE value = 'true' AND person_attribute_type_id = 1 AND voided = 0)
""")
def anti_join_not_in(fx):
    return fx.clinic.without_test_patients(fx.encounter).select("encounter_id")


@check("exists_reference_elsewhere", """
SELECT encounter_id FROM fx_version_encounter e WHERE EXISTS (SELECT 1 FROM fx_obs_version a
  JOIN fx_obs_version b ON b.previous_version = a.obs_id AND b.encounter_id <> a.encounter_id
  WHERE a.encounter_id = e.encounter_id)
""")
def exists_reference_elsewhere(fx):
    return joins.encounters_replaced_elsewhere(fx.obs_version)


@check("relational_division", """
SELECT encounter_id FROM fx_version_encounter e WHERE NOT EXISTS (SELECT 1 FROM fx_obs_version a
  WHERE a.encounter_id = e.encounter_id
  AND NOT EXISTS (SELECT 1 FROM fx_obs_version b WHERE b.previous_version = a.obs_id))
""")
def relational_division(fx):
    return joins.encounters_fully_replaced(fx.version_encounter, fx.obs_version).select("encounter_id")


_RECORDS = """SELECT a.person_id, a.county_district, a.city_village,
  CASE WHEN a.person_id % 3 <> 0 THEN a.address2 END AS address2,
  CASE WHEN a.person_id % 4 <> 0 THEN 'madre ' || (a.person_id * 7 % 90) END AS mother_name,
  CASE WHEN a.person_id % 5 <> 0 THEN '963-' || (a.person_id % 700) END AS phone
FROM {addresses} a"""


@check("similar_record_score", f"""
WITH r AS ({_RECORDS.replace('{addresses}', f'({ADDRESS_SQL})')}),
pairs AS (SELECT a.person_id, b.person_id AS similar_id,
    CASE WHEN a.county_district = b.county_district THEN 1 ELSE 0 END
    + CASE WHEN a.city_village = b.city_village THEN 1 ELSE 0 END
    + CASE WHEN a.address2 = b.address2 THEN 1 ELSE 0 END
    + CASE WHEN a.mother_name = b.mother_name THEN 3 ELSE 0 END
    + CASE WHEN a.phone = b.phone THEN 20 ELSE 0 END AS score
  FROM r a JOIN r b ON a.person_id <> b.person_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY person_id ORDER BY score DESC, similar_id)
    AS INT) AS rank FROM pairs WHERE score > 0)
SELECT person_id, similar_id, score, rank FROM ranked WHERE rank <= 5
""")
def similar_record_score(fx):
    """The five most similar other patients of every patient."""
    records = fx.spark.sql(_RECORDS, addresses=lookups.latest_addresses(fx.person_address))
    return joins.similar_records(records, "person_id", values.SIMILARITY_WEIGHTS, 5)


@check("first_match_per_group", """
SELECT obs_group_id, arg_min(value_coded, obs_id) AS certainty FROM fx_obs
WHERE voided = 0 AND concept_id = 104 GROUP BY obs_group_id
""")
def first_match_per_group(fx):
    return pivot_obs(active(fx.obs), "obs_group_id", [Measure("certainty", 104, "coded", pick="first")])


@check("number_rows_in_order", """
SELECT row_number() OVER (ORDER BY encounter_datetime, encounter_id) AS consult_id, encounter_id
FROM fx_encounter WHERE voided = 0 AND encounter_type = 1
""")
def number_rows_in_order(fx):
    rows = fx.clinic.encounters(values.CONSULT).select("encounter_id", "encounter_datetime")
    numbered = number_rows(rows, "consult_id", "encounter_datetime", "encounter_id")
    return numbered.select("consult_id", "encounter_id")


@check("sort_result", """
SELECT name, drug_id FROM fx_drug WHERE retired = 0 ORDER BY name, drug_id
""")
def sort_result(fx):
    return active(fx.drug).select("name", "drug_id").orderBy("name", "drug_id")


@check("union_all_coded_and_text", f"""
SELECT o.encounter_id, o.obs_id, n.name AS diagnosis FROM fx_clinic_obs o LEFT JOIN (
    SELECT concept_id, coalesce(max(name) FILTER (WHERE locale = 'es' AND locale_preferred = 1),
      max(name) FILTER (WHERE locale = 'en')) AS name FROM fx_concept_name
    WHERE concept_name_type <> 'SHORT' GROUP BY concept_id) n ON n.concept_id = o.value_coded
  WHERE o.voided = 0 AND o.concept_id = {_DX}
UNION ALL SELECT encounter_id, obs_id, value_text FROM fx_clinic_obs
  WHERE voided = 0 AND concept_id = {_DX_TEXT}
""")
def union_all_coded_and_text(fx):
    rows = prescriptions.all_diagnoses(fx.clinic, active(fx.clinic["obs"]))
    return rows.select("encounter_id", "obs_id", "diagnosis")
