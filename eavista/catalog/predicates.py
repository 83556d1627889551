"""Checks of projections, filters and recodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from eavista import values
from eavista.catalog.fixture import CONCEPT_IDS
from eavista.catalog.registry import check
from eavista.functions import text
from eavista.operators.filters import active, in_date_range, overlay, patient_or_range
from eavista.operators.lookups import concept_mapping
from eavista.operators.obs import Measure, pivot_obs


@check("filter_soft_delete", """
SELECT e.encounter_id FROM fx_encounter e JOIN fx_patient p ON p.patient_id = e.patient_id
WHERE e.voided = 0 AND p.voided = 0
""")
def filter_soft_delete(fx):
    return active(fx.encounter).join(active(fx.patient), "patient_id").select("encounter_id")


@check("filter_date_range", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '1996-03-01' AND CAST(o_orderdate AS DATE) <= DATE '1999-06-30'
""")
def filter_date_range(fx):
    rows = in_date_range(fx.table("orders"), "o_orderdate", "1996-03-01", "1999-06-30")
    return rows.select("o_orderkey", "o_totalprice")


@check("filter_optional_params", """
SELECT 'until' AS range, encounter_id FROM fx_encounter WHERE CAST(encounter_datetime AS DATE) <= DATE '1997-02-28'
UNION ALL SELECT 'since', encounter_id FROM fx_encounter
WHERE CAST(encounter_datetime AS DATE) >= DATE '1998-02-28'
UNION ALL SELECT 'all', encounter_id FROM fx_encounter
""")
def filter_optional_params(fx):
    rows = fx.encounter.select("encounter_id", "encounter_datetime")
    cases = {"until": (None, "1997-02-28"), "since": ("1998-02-28", None), "all": (None, None)}
    parts = [in_date_range(rows, "encounter_datetime", *bounds).select(
        F.lit(name).alias("range"), "encounter_id") for name, bounds in cases.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check("filter_patient_or_range", """
SELECT 'patient' AS chosen_by, encounter_id FROM fx_encounter WHERE patient_id = 3
UNION ALL SELECT 'range', encounter_id FROM fx_encounter
WHERE encounter_datetime >= TIMESTAMP '1997-01-01' AND encounter_datetime < TIMESTAMP '1998-01-01'
""")
def filter_patient_or_range(fx):
    """A patient overrides the date range."""
    rows = fx.encounter.select("encounter_id", "patient_id", "encounter_datetime")
    span = ("encounter_datetime", "1997-01-01", "1997-12-31")
    one = patient_or_range(rows, *span, patient_id=3).select(F.lit("patient").alias("chosen_by"), "encounter_id")
    many = patient_or_range(rows, *span).select(F.lit("range").alias("chosen_by"), "encounter_id")
    return one.unionByName(many)


@check("filter_encounter_type", """
SELECT encounter_id FROM fx_encounter WHERE voided = 0 AND encounter_type =
  (SELECT encounter_type_id FROM fx_encounter_type WHERE uuid = '4fb47712-34a6-40d2-8ed3-e153abbd25b7')
""")
def filter_encounter_type(fx):
    return fx.clinic.encounters(values.VITALS).select("encounter_id")


@check("filter_in_list", """
SELECT concept_id, count(*) AS row_count FROM fx_obs WHERE concept_id IN (101, 103, 107) GROUP BY concept_id
""")
def filter_in_list(fx):
    kept = fx.obs.filter(F.col("concept_id").isin(101, 103, 107))
    return kept.groupBy("concept_id").agg(F.count("*").alias("row_count"))


@check("filter_like_prefix", "SELECT drug_id, name FROM fx_drug WHERE name LIKE 'SSA: %' AND retired = 0")
def filter_like_prefix(fx):
    return active(fx.drug).filter(F.col("name").startswith("SSA: ")).select("drug_id", "name")


@check("match_code_ci", """
SELECT m.concept_id, t.code, s.name AS source FROM fx_reference_map m
JOIN fx_reference_term t ON t.concept_reference_term_id = m.concept_reference_term_id
JOIN fx_reference_source s ON s.concept_source_id = t.concept_source_id
WHERE lower(t.code) LIKE lower('bRAND#7-2')
""")
def match_code_ci(fx):
    mapping = concept_mapping(fx.reference_map, fx.reference_term.drop("retired"),
                              fx.reference_source.drop("retired"))
    return mapping.filter(F.lower("code") == "bRAND#7-2".lower())


def _facility_case(table: dict[str, str], column: str) -> str:
    whens = " ".join(f"WHEN strip_accents(lower('{k}')) THEN '{v}'" for k, v in table.items())
    return f"CASE strip_accents(lower(rtrim({column}))) {whens}"


@check("recode_case_lookup", f"""
SELECT e.encounter_id, l.name AS place, {_facility_case(values.NOTE_FACILITIES, 'l.name')}
  ELSE l.name END AS note_name, {_facility_case(values.HISTORY_FACILITIES, 'l.name')} END AS history_name
FROM fx_encounter e JOIN fx_location l ON l.location_id = e.location_id
""")
def recode_case_lookup(fx):
    """Names with other case, accents or trailing spaces still find their entry."""
    rows = fx.clinic.with_location(fx.encounter, "location_id", "place", "encounter_id")
    place = F.col("place")
    return rows.select(
        "encounter_id", "place", text.recode(place, values.NOTE_FACILITIES, place).alias("note_name"),
        text.recode(place, values.HISTORY_FACILITIES).alias("history_name"),
    )


@check("recode_if_flag", """
SELECT person_id, CASE gender WHEN 'M' THEN 'MASCULINO' WHEN 'F' THEN 'FEMININO' END AS gender_display,
  CASE WHEN birthdate < DATE '1960-01-01' THEN '1' ELSE '' END AS born_before_1960 FROM fx_person
""")
def recode_if_flag(fx):
    genders = text.fixed_map(values.GENDER_DISPLAY)
    old = F.col("birthdate") < F.lit("1960-01-01").cast("date")
    return fx.person.select(
        "person_id", F.try_element_at(genders, F.col("gender")).alias("gender_display"),
        F.when(old, "1").otherwise("").alias("born_before_1960"),
    )


@check("flag_missing_match", """
SELECT c_custkey, CASE WHEN o.o_custkey IS NULL THEN '1' ELSE '' END AS never_seen
FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
  AND o_totalprice > 300000) o ON o.o_custkey = c_custkey
""")
def flag_missing_match(fx):
    seen = fx.table("orders").filter("o_orderpriority = '4-NOT SPECIFIED' AND o_totalprice > 300000")
    seen = seen.select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("seen")).distinct()
    rows = fx.table("customer").join(seen, "c_custkey", "left")
    return rows.select("c_custkey", F.when(F.col("seen").isNull(), "1").otherwise("").alias("never_seen"))


@check("overlay_conditional", """
SELECT obs_id, CASE WHEN value_coded IN (211, 212) AND voided = 1 THEN 'void'
  WHEN concept_id = 104 THEN 'certainty' WHEN value_coded = 202 THEN 'second'
  WHEN value_coded >= 201 THEN 'first' ELSE 'none' END AS label
FROM fx_obs WHERE value_coded IS NOT NULL
""")
def overlay_conditional(fx):
    """Later updates overwrite earlier ones."""
    coded = F.col("value_coded")
    label = overlay(
        (coded >= 201, F.lit("first")),
        (coded == 202, F.lit("second")),
        (F.col("concept_id") == 104, F.lit("certainty")),
        (coded.isin(211, 212) & (F.col("voided") == 1), F.lit("void")),
        base=F.lit("none"),
    )
    return fx.obs.filter("value_coded IS NOT NULL").select("obs_id", label.alias("label"))


_GLUCOSE = CONCEPT_IDS["SERUM GLUCOSE"]


@check("fill_if_null", f"""
WITH g AS (SELECT e.visit_id, e.encounter_type AS kind, arg_max(o.value_numeric, o.obs_id) AS value
  FROM fx_clinic_obs o JOIN fx_encounter e ON e.encounter_id = o.encounter_id
  WHERE o.voided = 0 AND o.concept_id = {_GLUCOSE} AND e.visit_id IS NOT NULL GROUP BY 1, 2)
SELECT c.visit_id, coalesce(v.value, c.value) AS glucose FROM g c
LEFT JOIN g v ON v.visit_id = c.visit_id AND v.kind = 2 WHERE c.kind = 1
""")
def fill_if_null(fx):
    """The vitals value of the visit, else the consult's."""
    kinds = fx.encounter.filter("visit_id IS NOT NULL").select("encounter_id", "visit_id", "encounter_type")
    rows = active(fx.clinic["obs"]).join(kinds, "encounter_id")
    both = pivot_obs(rows, ["visit_id", "encounter_type"], [Measure("value", _GLUCOSE)])
    consult = both.filter("encounter_type = 1").select("visit_id", F.col("value").alias("_second"))
    vitals = both.filter("encounter_type = 2").select("visit_id", F.col("value").alias("_first"))
    joined = consult.join(vitals, "visit_id", "left")
    return joined.select("visit_id", F.coalesce("_first", "_second").alias("glucose"))


@check("delete_unqualified", """
SELECT obs_id, value_text FROM fx_obs WHERE voided = 0 AND value_text IS NOT NULL AND value_text <> 'NF'
""")
def delete_unqualified(fx):
    shown = active(fx.obs).withColumn("display", F.nullif("value_text", F.lit("NF")))
    return shown.filter("display IS NOT NULL").select("obs_id", F.col("display").alias("value_text"))


@check("project_localized_output", """
SELECT encounter_id AS "Consulta", strftime(encounter_datetime, '%Y-%m-%d %H:%M:%S') AS "Fecha",
  l.name AS "Clinica" FROM fx_encounter e LEFT JOIN fx_location l ON l.location_id = e.location_id
WHERE e.voided = 0
""")
def project_localized_output(fx):
    rows = fx.clinic.with_location(active(fx.encounter), "location_id", "Clinica", "encounter_id")
    return rows.select(
        F.col("encounter_id").alias("Consulta"),
        F.date_format("encounter_datetime", "yyyy-MM-dd HH:mm:ss").alias("Fecha"), "Clinica",
    )
