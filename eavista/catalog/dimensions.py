"""Checks of dictionary and people lookups, and of the two views."""

from __future__ import annotations

from pyspark.sql import functions as F

from eavista import values
from eavista.catalog.eav import NAMES
from eavista.catalog.fixture import CONCEPT_IDS
from eavista.catalog.registry import ADDRESS_SQL, NAME_SQL, check
from eavista.operators import lookups
from eavista.operators.filters import active
from eavista.operators.joins import left_lookup
from eavista.plans.registration import latest_registration


@check("lk_concept_from_mapping", """
SELECT d.drug_id, m.concept_id FROM fx_drug d LEFT JOIN (SELECT min(concept_id) AS concept_id,
  source, lower(code) AS code FROM fx_concept_mapping GROUP BY 2, 3) m
ON m.source = 'LOCAL' AND m.code = lower('DRUG-' || (d.drug_id * 2))
""")
def lk_concept_from_mapping(fx):
    """Codes compare without case; an unknown code gives null."""
    ids = fx.concept_mapping.filter("source = 'LOCAL'").groupBy(F.lower("code").alias("_code")).agg(
        F.min("concept_id").alias("concept_id"))
    code = F.lower(F.concat(F.lit("DRUG-"), (F.col("drug_id") * 2).cast("string")))
    return fx.drug.select("drug_id", code.alias("_code")).join(ids, "_code", "left").drop("_code")


@check("lk_concept_name", NAMES)
def lk_concept_name(fx):
    return fx.clinic.dictionary.best_names()


@check("lk_drug_name", """
SELECT o.obs_id, d.name AS drug_name FROM fx_obs o LEFT JOIN fx_drug d ON d.drug_id = o.value_drug
WHERE o.concept_id IN (106, 107)
""")
def lk_drug_name(fx):
    drugs = fx.drug.select(F.col("drug_id").alias("_drug"), F.col("name").alias("drug_name"))
    rows = fx.obs.filter(F.col("concept_id").isin(106, 107)).select("obs_id", "value_drug")
    return left_lookup(rows, drugs, "value_drug", "_drug", "obs_id").select("obs_id", "drug_name")


_DX = CONCEPT_IDS[values.DIAGNOSIS]


@check("lk_icd10", f"""
SELECT o.obs_id, m.code AS icd10 FROM fx_clinic_obs o LEFT JOIN (SELECT concept_id, min(code) AS code
  FROM fx_concept_mapping WHERE source = 'ICD-10-WHO' GROUP BY concept_id) m ON m.concept_id = o.value_coded
WHERE o.voided = 0 AND o.concept_id = {_DX}
""")
def lk_icd10(fx):
    dictionary = fx.clinic.dictionary
    icd = dictionary.codes_of(values.ICD10).select(
        F.col("concept_id").alias("_concept"), F.col("code").alias("icd10"))
    rows = dictionary.only_role(active(fx.clinic["obs"]), "concept_id", {"dx": values.DIAGNOSIS}, "_role")
    return left_lookup(rows, icd, "value_coded", "_concept", "obs_id").select("obs_id", "icd10")


@check("lk_encounter_type", """
SELECT encounter_id FROM fx_encounter WHERE encounter_type =
  (SELECT encounter_type_id FROM fx_encounter_type WHERE uuid = '0d16a7c9-07fb-43f6-8984-dd7787f26a5a')
""")
def lk_encounter_type(fx):
    wanted = fx.clinic.encounter_type(values.CLINICAL_HISTORY)
    return fx.encounter.filter(F.col("encounter_type") == wanted).select("encounter_id")


@check("lk_global_property", """
SELECT concept_name_id, name FROM fx_concept_name WHERE locale = 'en'
UNION ALL SELECT concept_name_id, name FROM fx_concept_name WHERE locale = 'es'
""")
def lk_global_property(fx):
    """A stored setting picks the first part, a missing one falls back to the default."""
    stored = fx.sql("SELECT 'default_locale' AS property, 'en' AS property_value FROM {region} "
                    "WHERE r_regionkey = 0")
    names = fx.concept_name
    chosen = lookups.global_property(stored, "default_locale", values.DEFAULT_LOCALE)
    fallback = lookups.global_property(stored, "unset", values.DEFAULT_LOCALE)
    parts = [names.filter(F.col("locale") == wanted).select("concept_name_id", "name")
             for wanted in (chosen, fallback)]
    return parts[0].unionByName(parts[1])


@check("lk_person", f"""
SELECT p.person_id AS patient_id, p.gender, CAST(p.birthdate AS VARCHAR) AS birthdate, n.given_name, n.family_name
FROM fx_person p LEFT JOIN ({NAME_SQL}) n ON n.person_id = p.person_id WHERE p.voided = 0
""")
def lk_person(fx):
    return fx.clinic.people().join(fx.clinic.names(), "patient_id", "left")


@check("lk_address", f"""
SELECT person_id AS patient_id, county_district, city_village, address1 FROM ({ADDRESS_SQL}) a
""")
def lk_address(fx):
    return fx.clinic.addresses().select("patient_id", "county_district", "city_village", "address1")


@check("lk_phone", """
SELECT person_id AS patient_id, value AS telephone FROM (SELECT *, row_number() OVER (PARTITION BY person_id
  ORDER BY date_created DESC, person_attribute_id DESC) AS place FROM fx_person_attribute
  WHERE voided = 0 AND person_attribute_type_id = 2) x WHERE place = 1
""")
def lk_phone(fx):
    return fx.clinic.phones()


@check("lk_identifier", """
SELECT p.c_custkey AS patient_id, a.identifier AS emr_id, b.identifier AS curp FROM customer p
LEFT JOIN fx_patient_identifier a ON a.patient_id = p.c_custkey AND a.identifier_type = 1 AND a.voided = 0
LEFT JOIN fx_patient_identifier b ON b.patient_id = p.c_custkey AND b.identifier_type = 2 AND b.voided = 0
""")
def lk_identifier(fx):
    rows = fx.patient.select("patient_id")
    for uuid, name in ((values.EMR_ID, "emr_id"), (values.NATIONAL_ID, "curp")):
        rows = rows.join(fx.clinic.identifiers(uuid, name), "patient_id", "left")
    return rows


@check("lk_user_name", f"""
SELECT u.user_id, trim(n.given_name || ' ' || n.family_name) AS entered_by
FROM fx_users u JOIN ({NAME_SQL}) n ON n.person_id = u.person_id
""")
def lk_user_name(fx):
    return lookups.user_names(fx.users, fx.person_name, "entered_by")


@check("lk_provider", """
SELECT f.encounter_id, p.name AS provider FROM (SELECT encounter_id, arg_min(provider_id, encounter_provider_id)
  AS provider_id FROM fx_encounter_provider WHERE voided = 0 GROUP BY encounter_id) f
LEFT JOIN fx_provider p ON p.provider_id = f.provider_id
""")
def lk_provider(fx):
    return fx.clinic.providers()


@check("lk_location", """
SELECT e.encounter_id, l.name AS location FROM fx_encounter e LEFT JOIN fx_location l ON l.location_id = e.location_id
""")
def lk_location(fx):
    rows = fx.clinic.with_location(fx.encounter, "location_id", "location", "encounter_id")
    return rows.select("encounter_id", "location")


@check("lk_registration_encounter", """
SELECT patient_id, encounter_id AS registration_encounter_id,
  CAST(CAST(encounter_datetime AS DATE) AS VARCHAR) AS registration_date
FROM fx_encounter e WHERE voided = 0 AND encounter_type = 3 AND NOT EXISTS (SELECT 1 FROM fx_encounter x
  WHERE x.patient_id = e.patient_id AND x.voided = 0 AND x.encounter_type = 3
  AND (x.encounter_datetime > e.encounter_datetime
       OR x.encounter_datetime = e.encounter_datetime AND x.encounter_id > e.encounter_id))
""")
def lk_registration_encounter(fx):
    return latest_registration(fx.clinic).select(
        "patient_id", "registration_encounter_id", F.to_date("registration_datetime").alias("registration_date"))


@check("view_report_mapping", """
SELECT m.concept_id, s.name AS source, t.code
FROM fx_reference_source s
JOIN fx_reference_term t ON t.concept_source_id = s.concept_source_id AND t.retired = 0
JOIN fx_reference_map m ON m.concept_reference_term_id = t.concept_reference_term_id
WHERE s.retired = 0 AND s.name IN ('LOCAL', 'CIEL')
""")
def view_report_mapping(fx):
    return lookups.concept_mapping(fx.reference_map, fx.reference_term, fx.reference_source,
                                   [fx.clinic.local_source, values.SHARED_SOURCE])


@check("view_current_name_address", f"""
SELECT p.person_id, p.gender, CAST(p.birthdate AS VARCHAR) AS birthdate, p.birthdate_estimated, n.given_name,
  n.family_name, n.middle_name AS nick_name, a.person_address_id, a.country, a.state_province AS department,
  a.city_village AS commune, a.address3 AS section_communal, a.address1 AS locality,
  a.address2 AS street_landmark
FROM fx_person p LEFT JOIN ({NAME_SQL}) n ON n.person_id = p.person_id
LEFT JOIN ({ADDRESS_SQL}) a ON a.person_id = p.person_id WHERE p.voided = 0
""")
def view_current_name_address(fx):
    return lookups.current_name_address(fx.person, fx.person_name, fx.person_address)
