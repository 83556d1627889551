"""Checks of migrations and row changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from eavista import values
from eavista.catalog.registry import check
from eavista.operators import migrate, stored
from eavista.operators.filters import active
from eavista.operators.obs import Measure, pivot_obs

_NOW = "2026-01-01 00:00:00"


def _now():
    return F.lit(_NOW).cast("timestamp_ntz")


@check("dml_update_from_join", """
WITH n AS (SELECT encounter_id, arg_max(value_text, obs_id) AS note FROM fx_obs
  WHERE voided = 0 AND concept_id = 107 GROUP BY encounter_id)
SELECT e.encounter_id, CASE WHEN n.encounter_id IS NOT NULL THEN n.note ELSE 'none' END AS note
FROM fx_encounter e LEFT JOIN n ON n.encounter_id = e.encounter_id
""")
def dml_update_from_join(fx):
    table = fx.encounter.select("encounter_id", F.lit("none").alias("note"))
    notes = pivot_obs(active(fx.obs), "encounter_id", [Measure("note", 107, "text")])
    return migrate.update_from(table, notes, "encounter_id", ["note"])


@check("dml_insert_select", """
SELECT encounter_id, patient_id, creator FROM fx_encounter WHERE encounter_type = 1
UNION ALL SELECT encounter_id, patient_id, NULL FROM fx_encounter WHERE encounter_type = 2 AND voided = 0
""")
def dml_insert_select(fx):
    """Inserted rows lack a column: it becomes null."""
    target = fx.encounter.filter("encounter_type = 1").select("encounter_id", "patient_id", "creator")
    rows = active(fx.encounter).filter("encounter_type = 2").select("patient_id", "encounter_id")
    return migrate.append_rows(target, rows)


_RULES = (("LOCAL", ("u1", "u3", "u5")), ("CIEL", ("u2",)))


@check("dml_delete_in", """
SELECT m.concept_map_id, m.concept_id FROM fx_reference_map m WHERE m.concept_map_id NOT IN (
  SELECT x.concept_map_id FROM fx_reference_map x
  JOIN fx_reference_term t ON t.concept_reference_term_id = x.concept_reference_term_id
  JOIN fx_reference_source s ON s.concept_source_id = t.concept_source_id
  JOIN fx_concept c ON c.concept_id = x.concept_id
  WHERE s.name = 'LOCAL' AND 'u' || (c.concept_id % 10) IN ('u1', 'u3', 'u5')
     OR s.name = 'CIEL' AND 'u' || (c.concept_id % 10) IN ('u2'))
""")
def dml_delete_in(fx):
    """Delete the mappings whose source and concept uuid are on the lists."""
    concept = fx.concept.select("concept_id", F.concat(F.lit("u"), (F.col("concept_id") % 10)).alias("uuid"))
    terms = fx.reference_term.select("concept_reference_term_id", "concept_source_id")
    sources = fx.reference_source.select("concept_source_id", F.col("name").alias("source"))
    mapping = fx.reference_map.join(terms, "concept_reference_term_id").join(sources, "concept_source_id")
    bad = migrate.inconsistent_mappings(mapping, concept, _RULES)
    left = migrate.delete_matching(fx.reference_map, bad, "concept_map_id")
    return left.select("concept_map_id", "concept_id")


_FULL_OBS = """SELECT obs_id, encounter_id, concept_id, value_coded, voided, 'u-' || obs_id AS uuid,
  CAST(NULL AS @ts) AS date_voided, CAST(NULL AS VARCHAR(100)) AS void_reason,
  CAST(NULL AS BIGINT) AS previous_version, CAST('FINAL' AS VARCHAR(20)) AS status
FROM {fx_obs} WHERE value_coded IS NOT NULL"""
_FULL_SPARK = _FULL_OBS.replace("@ts", "TIMESTAMP_NTZ")
_FULL_SQL = _FULL_OBS.replace("@ts", "TIMESTAMP").replace("{fx_obs}", "fx_obs")

_MIGRATED_SQL = f"""WITH o AS ({_FULL_SQL}), top AS (SELECT max(obs_id) AS id FROM o),
due AS (SELECT *, row_number() OVER (ORDER BY obs_id) AS n FROM o WHERE value_coded = 203 AND voided = 0)
SELECT obs_id, encounter_id, concept_id, value_coded, uuid,
  CASE WHEN value_coded = 203 AND voided = 0 THEN 1 ELSE voided END AS voided,
  CASE WHEN value_coded = 203 AND voided = 0 THEN '{_NOW}' END AS date_voided,
  CASE WHEN value_coded = 203 AND voided = 0 THEN '{values.RECODED_REASON}' END AS void_reason,
  CAST(NULL AS BIGINT) AS previous_version, status FROM o
UNION ALL SELECT top.id + n, encounter_id, concept_id, 202,
  regexp_replace(md5('amended ' || uuid), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5'),
  0, NULL, NULL, obs_id, 'AMENDED' FROM due, top"""


@check("dml_void_and_replace", _MIGRATED_SQL)
def dml_void_and_replace(fx):
    """The stored table after the change, of which only files with due rows are made anew."""
    path = fx.written("full_obs", lambda: fx.sql(_FULL_SPARK))
    return stored.recode_obs(fx.spark, path, 203, 202, _now()).result()


_SUPERSEDED = """SELECT encounter_id FROM fx_version_encounter e WHERE e.voided = 0
  AND EXISTS (SELECT 1 FROM fx_obs_version a JOIN fx_obs_version b ON b.previous_version = a.obs_id
              AND b.encounter_id <> a.encounter_id WHERE a.encounter_id = e.encounter_id)
  AND NOT EXISTS (SELECT 1 FROM fx_obs_version a WHERE a.encounter_id = e.encounter_id
    AND NOT EXISTS (SELECT 1 FROM fx_obs_version b WHERE b.previous_version = a.obs_id))"""


@check("dml_void_superseded_encounters", f"""
SELECT encounter_id, CASE WHEN encounter_id IN ({_SUPERSEDED}) THEN 1 ELSE voided END AS voided,
  CASE WHEN encounter_id IN ({_SUPERSEDED}) THEN '{values.DUPLICATE_REASON}' END AS void_reason,
  CASE WHEN encounter_id IN ({_SUPERSEDED}) THEN '{_NOW}' END AS date_voided,
  CASE WHEN encounter_id IN ({_SUPERSEDED}) THEN (SELECT user_id FROM fx_users WHERE system_id = 'admin') END
  AS voided_by FROM fx_version_encounter
""")
def dml_void_superseded_encounters(fx):
    encounters = fx.version_encounter.select(
        "encounter_id", "voided", F.lit(None).cast("string").alias("void_reason"),
        F.lit(None).cast("timestamp_ntz").alias("date_voided"), F.lit(None).cast("bigint").alias("voided_by"),
    )
    admin = fx.users.filter("system_id = 'admin'").agg(F.min("user_id")).scalar()
    return migrate.void_superseded_encounters(encounters, fx.obs_version, _now(), admin)


@check("dml_guarded_run", f"""
SELECT 'first' AS run, count(*) AS row_count, CAST(sum(voided) AS BIGINT) AS voided_rows FROM ({_MIGRATED_SQL}) a
UNION ALL SELECT 'second', count(*), CAST(sum(voided) AS BIGINT) FROM ({_MIGRATED_SQL}) b
""")
def dml_guarded_run(fx):
    """The second run finds the mark of the first one and changes nothing."""
    obs = fx.sql(_FULL_SPARK)

    def run(table):
        mark = table.filter(F.col("void_reason") == values.RECODED_REASON)
        return migrate.run_guarded(table, mark, lambda due: migrate.recode_obs(due, 203, 202, _now()))

    first = run(obs)
    second = run(first)
    count = lambda df, name: df.agg(
        F.count("*").alias("row_count"), F.sum("voided").alias("voided_rows")
    ).select(F.lit(name).alias("run"), "row_count", "voided_rows")
    return count(first, "first").unionByName(count(second, "second"))
