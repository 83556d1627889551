"""Checks of scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from eavista import values
from eavista.catalog.fixture import cid
from eavista.catalog.registry import NAME_SQL, check
from eavista.functions import ages, clinical, text
from eavista.operators.filters import active
from eavista.operators.lookups import latest_names
from eavista.operators.obs import Measure, ordered_list, pivot_obs


def born_and_seen(fx):
    """Encounters with the birth date of the patient."""
    people = fx.person.select(F.col("person_id").alias("patient_id"), "birthdate")
    return fx.encounter.select("encounter_id", "patient_id", "encounter_datetime").join(people, "patient_id")


BORN_SQL = """(SELECT e.encounter_id, p.birthdate AS b, CAST(e.encounter_datetime AS DATE) AS d
  FROM fx_encounter e JOIN fx_person p ON p.person_id = e.patient_id) s"""


def full_months_sql(b: str, d: str) -> str:
    """Completed months between two days, cut toward zero."""
    stamp = lambda x: f"((year({x}) * 12 + month({x})) * 32 + day({x}))"
    return f"CAST(trunc(({stamp(d)} - {stamp(b)}) / 32.0) AS INT)"


def full_years_sql(b: str, d: str) -> str:
    return f"CAST(trunc({full_months_sql(b, d)} / 12.0) AS INT)"


def number_sql(x: str) -> str:
    return (f"CASE WHEN {x} = floor({x}) AND abs({x}) < 1e18 THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) "
            f"ELSE CAST({x} AS VARCHAR) END")


@check("str_concat_null", """
SELECT person_name_id, given_name || ' ' || middle_name || ' ' || family_name AS whole FROM fx_person_name
""")
def str_concat_null(fx):
    """One missing part makes the whole text null."""
    whole = F.concat("given_name", F.lit(" "), "middle_name", F.lit(" "), "family_name")
    return fx.person_name.select("person_name_id", whole.alias("whole"))


_PIVOT = """(SELECT encounter_id, arg_max(value_numeric, obs_id) FILTER (WHERE concept_id = 101 AND voided = 0)
    AS quantity, arg_max(value_numeric, obs_id) FILTER (WHERE concept_id = 102 AND voided = 0) AS price,
    arg_max(value_text, obs_id) FILTER (WHERE concept_id = 107 AND voided = 0) AS note
  FROM fx_obs GROUP BY encounter_id) s"""


def _simple_pivot(fx):
    wanted = [Measure("quantity", 101), Measure("price", 102), Measure("note", 107, "text")]
    return fx.encounter.select("encounter_id").join(
        pivot_obs(active(fx.obs), "encounter_id", wanted), "encounter_id", "left")


@check("str_labelled_sentence", f"""
SELECT e.encounter_id, CASE WHEN quantity IS NULL THEN '' ELSE 'Cantidad: ' || {number_sql('quantity')} || '. ' END
  || CASE WHEN price IS NULL THEN '' ELSE 'Precio: ' || {number_sql('price')} || '. ' END
  || CASE WHEN note IS NULL THEN '' ELSE 'Nota: ' || note || '. ' END AS sentence
FROM fx_encounter e LEFT JOIN {_PIVOT} ON s.encounter_id = e.encounter_id
""")
def str_labelled_sentence(fx):
    parts = [("Cantidad: ", text.number_sql("quantity")), ("Precio: ", text.number_sql("price")),
             ("Nota: ", "note")]
    return _simple_pivot(fx).select("encounter_id", text.labelled_sentence(parts).alias("sentence"))


_HOME = ("feeding", "housing", "home_occupation")
_HOME_CODES = {c: code for c, code, _ in values.HISTORY_MEASURES if c in _HOME}
_HOME_SQL = ", ".join(
    f"arg_max(value_text, obs_id) FILTER (WHERE concept_id = {cid(code)}) AS {c}"
    for c, code in _HOME_CODES.items())
_HOME_IDS = ", ".join(str(cid(code)) for code in _HOME_CODES.values())
_HOME_FROM = f"""(SELECT encounter_id, {_HOME_SQL} FROM fx_clinic_obs
  WHERE voided = 0 AND concept_id IN ({_HOME_IDS}) GROUP BY encounter_id) s"""


def _home(fx):
    return pivot_obs(active(fx.clinic["obs"]), "encounter_id",
                     [Measure(c, code, "text") for c, code in _HOME_CODES.items()], fx.clinic.dictionary)


@check("str_join_nonnull", f"""
SELECT encounter_id, concat_ws(', ', feeding, housing, home_occupation) AS line FROM {_HOME_FROM}
""")
def str_join_nonnull(fx):
    """Present parts with commas between them and none at the end."""
    return _home(fx).select("encounter_id", F.concat_ws(", ", *_HOME).alias("line"))


@check("str_accumulate_line", f"""
SELECT encounter_id, 'Vivienda: ' || nullif(concat_ws(', ', housing, 'Trabajo: ' || home_occupation), '')
  AS line FROM {_HOME_FROM}
""")
def str_accumulate_line(fx):
    line = text.join_present(", ", F.col("housing"), text.prefixed("Trabajo: ", F.col("home_occupation")))
    return _home(fx).select("encounter_id", text.prefixed("Vivienda: ", line).alias("line"))


@check("str_trim", "SELECT location_id, trim(name) AS name FROM fx_location")
def str_trim(fx):
    return fx.location.select("location_id", F.trim("name").alias("name"))


@check("str_split_surname", """
SELECT person_name_id, trim(split_part(family_name, ' ', 1)) AS paternal,
  CASE WHEN position(' ' IN family_name) > 0 THEN trim(substr(family_name, position(' ' IN family_name) + 1))
  END AS maternal FROM fx_person_name
""")
def str_split_surname(fx):
    surname = F.col("family_name")
    return fx.person_name.select(
        "person_name_id", text.paternal_surname(surname).alias("paternal"),
        text.maternal_surname(surname).alias("maternal"))


@check("str_replace", """
SELECT encounter_id, replace(string_agg(value_text, ' | ' ORDER BY obs_id), ' | ', ', ') AS notes
FROM fx_obs WHERE voided = 0 AND concept_id = 107 GROUP BY encounter_id
""")
def str_replace(fx):
    lists = active(fx.obs).filter("concept_id = 107").groupBy("encounter_id").agg(
        ordered_list("value_text", values.LIST_SEPARATOR, "obs_id").alias("notes"))
    return lists.select("encounter_id", F.replace("notes", F.lit(values.LIST_SEPARATOR), F.lit(", "))
                        .alias("notes"))


@check("str_latin1_sanitize", r"""
SELECT doc_id, regexp_replace(text, '[^\x00-\x{FF}]', '?', 'g') AS clean,
  regexp_replace(text, '[^\x00-\x{FF}]', '?', 'g') <> text AS changed FROM documents
""")
def str_latin1_sanitize(fx):
    clean = text.latin1_text(F.col("text"))
    return fx.table("documents").select(
        "doc_id", clean.alias("clean"), (clean != F.col("text")).alias("changed"))


@check("str_sheet_name", f"""
SELECT e.encounter_id, n.family_name || '-' || strftime(e.encounter_datetime, '%Y-%m-%d') || ' ' || e.encounter_id
  AS for_many, strftime(e.encounter_datetime, '%Y-%m-%d') || ' ' || e.encounter_id AS for_one
FROM fx_encounter e JOIN ({NAME_SQL}) n ON n.person_id = e.patient_id
""")
def str_sheet_name(fx):
    names = latest_names(fx.person_name)
    rows = fx.encounter.select("encounter_id", "patient_id", "encounter_datetime").join(
        names.select(F.col("person_id").alias("patient_id"), "family_name"), "patient_id")
    day, number = F.col("encounter_datetime"), F.col("encounter_id")
    return rows.select("encounter_id", text.sheet_name(day, number, F.col("family_name")).alias("for_many"),
                       text.sheet_name(day, number).alias("for_one"))


@check("str_wrap_words", """
WITH folded AS (
  SELECT doc_id, list_reduce(string_split(text, ' '), lambda s, w: CASE
      WHEN length(CASE WHEN s.line = '' THEN w.line ELSE s.line || ' ' || w.line END) <= 80
      THEN {'done': s.done, 'line': CASE WHEN s.line = '' THEN w.line ELSE s.line || ' ' || w.line END, 'n': s.n}
      ELSE {'done': CASE WHEN s.n = 0 THEN s.line ELSE s.done || chr(10) || s.line END, 'line': w.line, 'n': s.n + 1} END) AS s
  FROM (SELECT doc_id, list_prepend({'done': '', 'line': '', 'n': 0},
      list_transform(string_split(text, ' '), lambda w: {'done': '', 'line': w, 'n': 0})) AS text FROM documents)
)
SELECT doc_id, CAST(s.n + CASE WHEN s.line = '' THEN 0 ELSE 1 END AS INT) AS line_count,
  CASE WHEN s.line = '' THEN s.done WHEN s.n = 0 THEN s.line ELSE s.done || chr(10) || s.line END AS wrapped FROM folded
""".replace("list_reduce(string_split(text, ' '), ", "list_reduce(text, "))
def str_wrap_words(fx):
    """Whole documents wrapped to 80 characters: number of lines and the text as lines."""
    lines = text.wrap_words(F.col("text"), 80)
    return fx.table("documents").select("doc_id", lines.alias("lines")).select(
        "doc_id", F.size("lines").alias("line_count"), F.array_join("lines", "\n").alias("wrapped"))


@check("date_truncate", """
SELECT encounter_id, CAST(CAST(encounter_datetime AS DATE) AS VARCHAR) AS day FROM fx_encounter
""")
def date_truncate(fx):
    return fx.encounter.select("encounter_id", F.to_date("encounter_datetime").alias("day"))


@check("date_format_parts", """
SELECT encounter_id, strftime(encounter_datetime, '%H:%M') AS time,
  strftime(encounter_datetime, '%Y-%m-%d %H:%M:%S') AS moment FROM fx_encounter
""")
def date_format_parts(fx):
    moment = F.col("encounter_datetime")
    return fx.encounter.select("encounter_id", F.date_format(moment, "HH:mm").alias("time"),
                               ages.date_and_time_text(moment).alias("moment"))


@check("date_year_equal", """
SELECT visit_id FROM fx_visit WHERE year(date_started) = year(date_stopped) AND date_started < date_stopped
""")
def date_year_equal(fx):
    return fx.visit.filter(
        (F.year("date_started") == F.year("date_stopped")) & (F.col("date_started") < F.col("date_stopped"))
    ).select("visit_id")


@check("age_decimal_years", f"SELECT encounter_id, round(date_diff('day', b, d) / 365.25, 1) AS age FROM {BORN_SQL}")
def age_decimal_years(fx):
    age = ages.decimal_years(F.col("birthdate"), F.col("encounter_datetime"))
    return born_and_seen(fx).select("encounter_id", age.alias("age"))


@check("age_full_years", f"SELECT encounter_id, {full_years_sql('b', 'd')} AS age FROM {BORN_SQL}")
def age_full_years(fx):
    age = ages.full_years(F.col("birthdate"), F.col("encounter_datetime"))
    return born_and_seen(fx).select("encounter_id", age.alias("age"))


AGE_DAYS_SQL = f"CAST(date_diff('day', CAST(b + to_months({full_months_sql('b', 'd')}) AS DATE), d) AS INT)"


@check("age_months_days", f"""
SELECT encounter_id, {full_months_sql('b', 'd')} % 12 AS months, {AGE_DAYS_SQL} AS days FROM {BORN_SQL}
""")
def age_months_days(fx):
    born, on = F.col("birthdate"), F.col("encounter_datetime")
    return born_and_seen(fx).select("encounter_id", ages.months_after_year(born, on).alias("months"),
                                    ages.days_after_month(born, on).alias("days"))


def bmi_sql(weight: str, height: str) -> str:
    """Ties go to the even digit."""
    metres = f"(nullif({height}, 0) / 100)"
    return f"round_even({weight} / ({metres} * {metres}) * 10, 0) / 10"


@check("num_bmi", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  {bmi_sql('l_extendedprice / 1000', 'l_quantity - 1')} AS bmi FROM lineitem
""")
def num_bmi(fx):
    """Zero and missing heights give no index."""
    bmi = clinical.bmi(F.col("l_extendedprice") / 1000, F.col("l_quantity") - 1)
    return fx.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", bmi.alias("bmi"))


_BP = {"s": "SYSTOLIC BLOOD PRESSURE", "d": "DIASTOLIC BLOOD PRESSURE"}
_BP_SQL = ", ".join(f"arg_max(value_numeric, obs_id) FILTER (WHERE concept_id = {cid(c)}) AS {k}"
                    for k, c in _BP.items())


@check("num_ratio_text", f"""
SELECT encounter_id, CASE WHEN s IS NULL THEN '' ELSE {number_sql('s')} || '/' || {number_sql('d')} END AS bp
FROM (SELECT encounter_id, {_BP_SQL} FROM fx_clinic_obs WHERE voided = 0
  AND concept_id IN ({cid(_BP['s'])}, {cid(_BP['d'])}) GROUP BY encounter_id) x
""")
def num_ratio_text(fx):
    rows = pivot_obs(active(fx.clinic["obs"]), "encounter_id",
                     [Measure(k, code) for k, code in _BP.items()], fx.clinic.dictionary)
    return rows.select("encounter_id", clinical.blood_pressure_text("s", "d").alias("bp"))


@check("num_to_text", f"""
SELECT obs_id, {number_sql('value_numeric')} AS shown FROM fx_obs WHERE value_numeric IS NOT NULL
""")
def num_to_text(fx):
    return fx.obs.filter("value_numeric IS NOT NULL").select(
        "obs_id", text.number_text("value_numeric").alias("shown"))


@check("cond_if", """
SELECT obs_id, coalesce(value_text, CASE WHEN value_numeric > 25 THEN 'alto' ELSE 'otro' END) AS shown,
  CASE value_coded WHEN 201 THEN 'a' WHEN 202 THEN 'b' END AS letter FROM fx_obs
""")
def cond_if(fx):
    high = F.when(F.col("value_numeric") > 25, "alto").otherwise("otro")
    letter = F.when(F.col("value_coded") == 201, "a").when(F.col("value_coded") == 202, "b")
    return fx.obs.select("obs_id", F.coalesce("value_text", high).alias("shown"), letter.alias("letter"))


@check("gen_uuid_now", """
SELECT count(*) AS encounters, count(*) AS uuids, count(*) AS well_formed, count(*) AS dated FROM fx_encounter
""")
def gen_uuid_now(fx):
    """A fresh uuid and the current time per row: how many there are, differ, have the form and a time of today."""
    form = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    rows = fx.encounter.select("encounter_id", F.uuid().alias("uuid"), F.current_timestamp().alias("now"))
    return rows.groupBy("uuid").agg(F.count("*").alias("n"), F.max("now").alias("now")).agg(
        F.sum("n").alias("encounters"), F.count("*").alias("uuids"),
        F.count_if(F.col("uuid").rlike(form)).alias("well_formed"), F.count("now").alias("dated"))
