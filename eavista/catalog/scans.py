"""Checks of sources, dictionaries and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from eavista import values
from eavista.catalog.fixture import CONCEPT_IDS
from eavista.catalog.registry import END, NAME_SQL, START, check
from eavista.functions import text
from eavista.operators.filters import active
from eavista.operators.lookups import latest_names
from eavista.plans import prescriptions
from eavista.plans.report import design_variants, nested
from eavista.session import fresh_path
from eavista.sources import dictionaries, exports, sites


@check("scan_site_table", """
SELECT o_orderkey AS encounter_id, o_custkey AS patient_id, o_totalprice AS amount
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
""")
def scan_site_table(fx):
    """A site's extraction query over Parquet: the columns and the filter reach the scan."""
    site = fx.spark.read.parquet(f"{fx.sf_dir}/orders.parquet")
    columns = {"encounter_id": "o_orderkey", "patient_id": "o_custkey", "amount": "o_totalprice"}
    return sites.extract(site, columns, F.expr("o_orderdate >= TIMESTAMP_NTZ '1997-01-01'"))


@check("scan_declared_schema", """
SELECT CAST(patient_id AS INT) AS patient_id, CAST(encounter_id AS INT) AS encounter_id,
  CAST(encounter_type AS INT) AS encounter_type FROM fx_encounter WHERE voided = 0
""")
def scan_declared_schema(fx):
    return sites.encounter_extract(fx.encounter, rows=None)


@check("scan_sample_limit", """
SELECT CAST(patient_id AS INT) AS patient_id, CAST(encounter_id AS INT) AS encounter_id,
  CAST(encounter_type AS INT) AS encounter_type
FROM fx_encounter WHERE voided = 0 ORDER BY encounter_id LIMIT 10
""")
def scan_sample_limit(fx):
    return sites.encounter_extract(fx.encounter)


def _csv_round_trip(fx, df, name):
    """Write a dictionary file to the shared folder and read it as the loaders do."""
    path = fresh_path(fx.spark, name)
    df.write.option("header", True).option("escape", '"').csv(path)
    return dictionaries.read_csv(fx.spark, path)


@check("load_concept_dictionary", """
SELECT 'u' || concept_id AS uuid, CASE WHEN concept_id % 6 = 0 THEN 1 ELSE 0 END AS retired,
  CASE WHEN concept_id % 2 = 0 THEN 'en, ' || name END AS name_en, name AS name_es,
  CASE WHEN concept_id % 2 = 1 THEN 'c "' || name || '"' END AS short_name_en,
  CAST(NULL AS VARCHAR) AS short_name_es, CAST(NULL AS VARCHAR) AS description,
  'Drug' AS class, 'N/A' AS datatype, CAST(NULL AS VARCHAR) AS answers FROM fx_concept
""")
def load_concept_dictionary(fx):
    """Two files with different columns, quotes and commas become one table."""
    common = [F.expr("'u' || concept_id").alias("uuid")]
    retired = F.expr("CASE WHEN concept_id % 6 = 0 THEN 'True' END").alias("Void/Retire")
    spanish = F.col("name").alias("Fully specified name:es")
    kind = [F.lit("Drug").alias("Data class"), F.lit("N/A").alias("Data type")]
    even = fx.concept.filter("concept_id % 2 = 0").select(
        *common, retired, F.expr("'en, ' || name").alias("Fully specified name:en"), spanish, *kind,
        F.lit(None).cast("string").alias("_order:50"),
    )
    odd = fx.concept.filter("concept_id % 2 = 1").select(
        *common, retired, spanish, F.expr("""'c "' || name || '"'""").alias("Short name:en"), *kind,
    )
    return dictionaries.concepts(
        [_csv_round_trip(fx, even, "concepts-a"), _csv_round_trip(fx, odd, "concepts-b")]
    )


@check("unpivot_concept_mappings", """
SELECT p_partkey AS uuid, 'SAME-AS' AS relation, 'LOCAL' AS source, trim(u.code) AS code
FROM part, unnest(string_split(p_brand || ';' || p_type, ';')) AS u(code)
UNION ALL SELECT p_partkey, 'SAME-AS', 'CIEL', CAST(p_partkey + 7 AS VARCHAR) FROM part
WHERE p_partkey % 3 = 0
UNION ALL SELECT p_partkey, 'NARROWER-THAN', 'ICD-10-WHO', 'A' || p_size FROM part WHERE p_size > 25
UNION ALL SELECT p_partkey, 'NARROWER-THAN', 'ICD-10-WHO', 'B' || p_size FROM part WHERE p_size > 40
""")
def unpivot_concept_mappings(fx):
    wide = fx.table("part").select(
        F.col("p_partkey").alias("uuid"),
        F.expr("p_brand || '; ' || p_type").alias("Mappings|SAME-AS|LOCAL|Name"),
        F.expr("CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey + 7 AS STRING) END").alias(
            "Mappings|SAME-AS|CIEL"),
        F.expr("CASE WHEN p_size > 25 THEN 'A' || p_size END").alias(
            "Mappings|NARROWER-THAN|ICD-10-WHO"),
        F.expr("CASE WHEN p_size > 40 THEN 'B' || p_size END").alias(
            "Mappings|NARROWER-THAN|ICD-10-WHO 2nd"),
    )
    return dictionaries.unpivot_mappings(wide)


@check("explode_answers", """
SELECT base_id, 1 AS position, l_returnflag AS answer FROM fx_obs_base
UNION ALL SELECT base_id, 2, l_linestatus FROM fx_obs_base
""")
def explode_answers(fx):
    cells = fx.obs_base.select("base_id", F.concat_ws("; ", "l_returnflag", "l_linestatus").alias("cell"))
    return dictionaries.explode_answers(cells, "base_id", "cell")


@check("load_concept_sets", """
SELECT set_name, member, sort_weight, retired,
  CAST(row_number() OVER (PARTITION BY set_name ORDER BY sort_weight, member) AS INT) AS position
FROM (SELECT p_brand AS set_name, p_name || ' ' || p_partkey AS member,
        CAST(p_size AS DOUBLE) AS sort_weight, CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END AS retired
      FROM part) s
""")
def load_concept_sets(fx):
    edges = fx.table("part").select(
        F.col("p_brand").alias("Concept"),
        F.expr("p_name || ' ' || p_partkey").alias("Member"),
        F.lit("CONCEPT-SET").alias("Member Type"),
        F.col("p_size").alias("Sort Weight"),
        F.expr("CASE WHEN p_partkey % 7 = 0 THEN 'true' END").alias("Void/Retire"),
    )
    return dictionaries.concept_sets([_csv_round_trip(fx, edges, "sets")])


@check("concept_set_closure", """
WITH RECURSIVE reach(root, member, depth) AS (
  SELECT concept_set, concept_id, 1 FROM fx_concept_set
  UNION
  SELECT r.root, s.concept_id, r.depth + 1 FROM reach r
  JOIN fx_concept_set s ON s.concept_set = r.member)
SELECT root, member, min(depth) AS depth,
  member NOT IN (SELECT concept_set FROM fx_concept_set) AS leaf
FROM reach GROUP BY root, member
""")
def concept_set_closure(fx):
    return dictionaries.set_closure(fx.concept_set, "concept_set", "concept_id")


_MEMBERS = """SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN UPPER('droga ' || p_name) || ' '
  WHEN 1 THEN 'local:DRUG-' || p_partkey WHEN 2 THEN 'CIEL:' || p_partkey ELSE p_name || ' x' END
  AS member, CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS retired FROM {part}"""


@check("dictionary_integrity_check", f"""
WITH members AS ({_MEMBERS.replace('{part}', 'part')}),
flags AS (SELECT lower(trim(name)) AS name, min(CASE WHEN concept_id % 46 = 0 THEN 1 ELSE 0 END) AS low,
  max(CASE WHEN concept_id % 46 = 0 THEN 1 ELSE 0 END) AS high FROM fx_concept GROUP BY 1)
SELECT id, member, retired, 'no such concept' AS problem FROM members m
WHERE NOT EXISTS (SELECT 1 FROM fx_concept c WHERE lower(trim(c.name)) = lower(trim(m.member)))
  AND NOT EXISTS (SELECT 1 FROM fx_concept_mapping k
                  WHERE lower(k.source || ':' || k.code) = lower(trim(m.member)))
UNION ALL
SELECT id, member, m.retired, 'retired differs' FROM members m
JOIN flags f ON f.name = lower(trim(m.member)) WHERE m.retired < f.low OR m.retired > f.high
""")
def dictionary_integrity_check(fx):
    members = fx.sql(_MEMBERS)
    flags = fx.concept.select(
        "name", F.expr("CASE WHEN concept_id % 46 = 0 THEN 1 ELSE 0 END").alias("retired")
    )
    lost = dictionaries.unresolved_members(members, fx.concept, fx.concept_mapping)
    torn = dictionaries.retired_disagreements(members, flags)
    return lost.withColumn("problem", F.lit("no such concept")).unionByName(
        torn.withColumn("problem", F.lit("retired differs"))
    )


@check("load_location_tags", """
SELECT location_id, name, 'Visit Location' AS tag FROM fx_location_tags_wide WHERE visit_location = 'TRUE'
UNION ALL SELECT location_id, name, 'Vitals Location' FROM fx_location_tags_wide
WHERE vitals_location = 'TRUE'
UNION ALL SELECT location_id, name, 'Archives Location' FROM fx_location_tags_wide
WHERE archives_location = 'TRUE'
""")
def load_location_tags(fx):
    return dictionaries.location_tags(
        fx.location_tags_wide, ["location_id", "name"],
        {"visit_location": "Visit Location", "vitals_location": "Vitals Location",
         "archives_location": "Archives Location"},
    )


@check("load_programs", """
SELECT 'p' || r_regionkey AS program_uuid, r_name AS program,
  CASE WHEN r_regionkey = 2 THEN 1 ELSE 0 END AS program_retired,
  CASE WHEN r_regionkey <> 3 THEN 10000 + r_regionkey END AS program_concept_id,
  'w' || n_nationkey AS workflow_uuid, 10000 + n_nationkey AS workflow_concept_id,
  's' || c_custkey AS state_uuid, CASE WHEN c_custkey % 9 <> 0 THEN CAST(10000 + c_custkey % 100 AS INT) END
  AS state_concept_id, c_custkey % 2 = 0 AS initial
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
""")
def load_programs(fx):
    """Region, nation and customer stand for program, workflow and state files."""
    program = fx.sql(
        "SELECT 'p' || r_regionkey AS Uuid, r_name AS Name, CASE WHEN r_regionkey = 2 THEN 'true' END "
        "AS `Void/Retire`, CASE WHEN r_regionkey = 3 THEN 'LOCAL:none' ELSE 'LOCAL:drug-' || r_regionkey "
        "END AS `Program concept`, 'CIEL:1443' AS `Outcomes concept` FROM {region}"
    )
    workflow = fx.sql(
        "SELECT 'w' || n_nationkey AS Uuid, 'p' || n_regionkey AS Program, "
        "'LOCAL:DRUG-' || n_nationkey AS `Workflow concept` FROM {nation}"
    )
    state = fx.sql(
        "SELECT 's' || c_custkey AS Uuid, CASE WHEN c_custkey % 2 = 0 THEN 'w' || c_nationkey "
        "ELSE 'LOCAL:DRUG-' || c_nationkey END AS Workflow, CASE WHEN c_custkey % 9 = 0 THEN 'X:1' "
        "ELSE 'LOCAL:drug-' || (c_custkey % 100) END AS `State concept`, "
        "CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS Initial, "
        "CAST(NULL AS STRING) AS Terminal FROM {customer}"
    )
    return dictionaries.programs(program, workflow, state, fx.concept_mapping).select(
        "program_uuid", "program", "program_retired", "program_concept_id", "workflow_uuid",
        "workflow_concept_id", "state_uuid", "state_concept_id", "initial",
    )


@check("resolve_placeholders", """
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '${nation.x' || c_custkey || '}'
  WHEN c_custkey % 5 = 1 THEN c_name ELSE n_name END AS place
FROM customer JOIN nation ON n_nationkey = c_nationkey
""")
def resolve_placeholders(fx):
    cell = F.expr(
        "CASE WHEN c_custkey % 5 = 0 THEN concat('$', '{nation.x', c_custkey, '}') "
        "WHEN c_custkey % 5 = 1 THEN c_name ELSE concat('$', '{nation.', c_nationkey, '}') END"
    )
    cells = fx.table("customer").select("c_custkey", cell.alias("place"))
    constants = fx.table("nation").select(
        F.concat(F.lit("nation."), F.col("n_nationkey").cast("string")).alias("name"),
        F.col("n_name").alias("value"),
    )
    return dictionaries.resolve_placeholders(cells, "place", constants)


@check("validate_identifier_format", r"""
SELECT patient_identifier_id, identifier,
  CASE WHEN identifier_type = 3 THEN regexp_full_match(identifier, '\w{1,4}\d{6}') ELSE TRUE END AS valid
FROM fx_patient_identifier
""")
def validate_identifier_format(fx):
    checked = dictionaries.with_format_check(fx.patient_identifier, fx.identifier_types)
    return checked.select("patient_identifier_id", "identifier", "valid")


@check("split_address_hierarchy", """
WITH c AS (SELECT r_name, CAST(r_regionkey AS VARCHAR) AS r, c_mktsegment AS d, n_name, c_name
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
SELECT DISTINCT 1 AS depth, 'state_province' AS level, r_name AS name, r AS identifier,
  '' AS parent_path, r_name AS path FROM c
UNION ALL SELECT DISTINCT 2, 'county_district', d, NULL, r_name, r_name || '|' || d FROM c
UNION ALL SELECT DISTINCT 3, 'city_village', n_name, NULL, r_name || '|' || d,
  r_name || '|' || d || '|' || n_name FROM c
UNION ALL SELECT DISTINCT 4, 'address2', c_name, NULL, r_name || '|' || d || '|' || n_name,
  r_name || '|' || d || '|' || n_name || '|' || c_name FROM c
""")
def split_address_hierarchy(fx):
    lines = fx.sql(
        "SELECT r_name || '^' || r_regionkey || '|' || c_mktsegment || ' |' || n_name || '|' || c_name "
        "AS line FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey "
        "JOIN {region} ON r_regionkey = n_regionkey"
    )
    return dictionaries.split_hierarchy(lines, "line")


@check("format_address_lines", """
SELECT person_address_id, city_village || ', ' || address1 AS line_1,
  county_district || ', ' || state_province AS line_2 FROM fx_person_address WHERE voided = 0
""")
def format_address_lines(fx):
    address = active(fx.person_address)
    first, second = text.address_lines({c: address[c] for c in values.ADDRESS_LEVELS})
    return address.select("person_address_id", first.alias("line_1"), second.alias("line_2"))


@check("sink_csv_export", f"""
SELECT CAST(e.encounter_id AS VARCHAR) AS encounter_id,
  strftime(e.encounter_datetime, '%d-%b-%Y %H:%M:%S') AS moment, n.family_name AS surname
FROM fx_encounter e JOIN ({NAME_SQL}) n ON n.person_id = e.patient_id
""")
def sink_csv_export(fx):
    """The export written in Latin-1, read back as text."""
    names = latest_names(fx.person_name).select("person_id", "family_name")
    rows = fx.encounter.join(names, F.col("patient_id") == F.col("person_id")).select(
        "encounter_id", F.col("encounter_datetime").alias("moment"),
        F.concat("family_name", F.lit("—€")).alias("surname"),
    )
    path = fresh_path(fx.spark, "export")
    exports.write_csv(rows, path)
    return fx.spark.read.csv(path, header=True, encoding=values.CSV_ENCODING)


@check("clean_blacklisted_chars", r"""
SELECT doc_id, regexp_replace(text, '[^\x00-\x7F\p{L}]', '', 'g') AS clean FROM documents
""")
def clean_blacklisted_chars(fx):
    return fx.table("documents").select("doc_id", text.without_blacklisted(F.col("text")).alias("clean"))


@check("sink_per_sheet", f"""
SELECT e.encounter_id, n.family_name || '-' || strftime(e.encounter_datetime, '%Y-%m-%d') || ' '
  || e.encounter_id AS sheet_name
FROM fx_encounter e JOIN ({NAME_SQL}) n ON n.person_id = e.patient_id
WHERE e.voided = 0 AND e.encounter_type = 4
""")
def sink_per_sheet(fx):
    """One sheet per history encounter, read back with the sheet names."""
    names = latest_names(fx.person_name).select("person_id", F.col("family_name").alias("last_name"))
    live = active(fx.encounter).filter("encounter_type = 4")
    rows = live.join(names, F.col("patient_id") == F.col("person_id")).withColumn(
        "sheet_name",
        text.sheet_name(F.col("encounter_datetime"), F.col("encounter_id"), F.col("last_name")),
    )
    path = fresh_path(fx.spark, "sheets")
    exports.write_sheets(rows.select("encounter_id", "sheet_name"), path)
    return fx.spark.read.schema("encounter_id bigint, sheet_name string").json(path)


@check("report_design_variants", """
SELECT encounter_id, design, district_name FROM fx_encounter,
  (VALUES ('IMSS-Bienestar', NULL), ('Juris X', 'X MOTOZINTLA'), ('Juris IV', 'IV VILLAFLORES'))
  AS d(design, district_name) WHERE encounter_type = 1 AND voided = 0
""")
def report_design_variants(fx):
    consults = fx.clinic.encounters(values.CONSULT).select("encounter_id")
    return design_variants(consults, values.NOTE_DESIGNS)


_MEDICATION, _GROUP = CONCEPT_IDS[values.MEDICATION], CONCEPT_IDS[values.MEDICATION_GROUP]


@check("nested_report", f"""
WITH o AS (SELECT * FROM fx_clinic_obs WHERE voided = 0),
controlled AS (SELECT drug_id FROM fx_drug WHERE retired = 0 AND concept_id IN
  (SELECT concept_id FROM fx_concept_set WHERE concept_set = {CONCEPT_IDS[values.CONTROLLED_SET]})),
consult AS (SELECT encounter_id FROM fx_encounter e WHERE voided = 0 AND encounter_type = 1
  AND encounter_datetime >= DATE '{START}' AND encounter_datetime < DATE '{END}' + INTERVAL '1' DAY
  AND EXISTS (SELECT 1 FROM o WHERE o.encounter_id = e.encounter_id AND o.concept_id = {_MEDICATION}
              AND o.value_drug IN (SELECT drug_id FROM controlled))),
line AS (SELECT p.encounter_id, p.obs_id, (SELECT arg_min(d.name, k.obs_id) FROM o k
    JOIN fx_drug d ON d.drug_id = k.value_drug
    WHERE k.obs_group_id = p.obs_id AND k.concept_id = {_MEDICATION}) AS name
  FROM o p WHERE p.concept_id = {_GROUP})
SELECT c.encounter_id, count(l.obs_id) AS medications,
  coalesce(string_agg(coalesce(l.name, '-'), '; ' ORDER BY l.obs_id) FILTER (WHERE l.obs_id IS NOT NULL),
           '') AS names
FROM consult c LEFT JOIN line l USING (encounter_id) GROUP BY c.encounter_id
""")
def nested_report(fx):
    """Encounters with their medication lines as one array, shown here as count and names."""
    encounters = prescriptions.controlled_encounters(fx.clinic, START, END)
    lines = prescriptions.controlled_meds(fx.clinic, START, END)
    whole = nested(encounters, lines, "encounter_id", "prescriptions", "obs_group_id")
    names = F.transform("prescriptions", lambda line: F.coalesce(line["name"], F.lit("-")))
    return whole.select(
        "encounter_id", F.size("prescriptions").cast("bigint").alias("medications"),
        F.array_join(names, "; ").alias("names"),
    )


def _per_site(fx):
    """The encounters of each site; location modulo 12 tells the site."""
    return {
        site: fx.encounter.filter(F.col("location_id") % 12 == number - 1).select(
            "encounter_id", "patient_id")
        for site, number in values.SITES.items()
    }


_SITE_NAMES = "CASE location_id % 12 " + " ".join(
    f"WHEN {n - 1} THEN '{s}'" for s, n in values.SITES.items()) + " END"


@check("site_consolidation", f"""
SELECT encounter_id, patient_id, {_SITE_NAMES} AS site, location_id % 12 + 1 AS partition_num
FROM fx_encounter
""")
def site_consolidation(fx):
    return sites.consolidate(_per_site(fx))


@check("sink_partition_overwrite", """
SELECT location_id % 12 + 1 AS partition_num, count(*) AS encounters,
  CAST(sum(CASE WHEN location_id % 12 + 1 = 3 THEN -patient_id ELSE patient_id END) AS BIGINT) AS patients
FROM fx_encounter WHERE location_id % 12 + 1 NOT IN (3, 4) OR location_id % 12 + 1 = 3 AND encounter_id % 2 = 0 GROUP BY 1
""")
def sink_partition_overwrite(fx):
    """Load all sites, then sites 3 and 4 again: one with other rows, one with none. Only they change."""
    path = fresh_path(fx.spark, "warehouse")
    everything = _per_site(fx)
    sites.overwrite_partitions(sites.consolidate(everything), path)
    again = everything["honduras"].filter("encounter_id % 2 = 0").withColumn(
        "patient_id", -F.col("patient_id"))
    sites.overwrite_partitions(sites.consolidate({"honduras": again}), path, loaded=(3, 4))
    return fx.spark.read.parquet(path).groupBy("partition_num").agg(
        F.count("*").alias("encounters"), F.sum("patient_id").alias("patients"))


@check("range_partition_assign", """
SELECT CASE WHEN v < 1 THEN 1 WHEN v > 50 THEN 51 ELSE v END AS partition_num, count(*) AS row_count
FROM (SELECT CAST(l_partkey % 60 - 3 AS INT) AS v FROM lineitem) s GROUP BY 1
""")
def range_partition_assign(fx):
    value = F.expr("CAST(l_partkey % 60 - 3 AS INT)")
    parts = fx.table("lineitem").select(sites.range_partition(value).alias("partition_num"))
    return parts.groupBy("partition_num").agg(F.count("*").alias("row_count"))
