"""Edge cases and properties on small rows, against plain Python where it helps."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import DataFrame, functions as F, types as T

from eavista import values
from eavista.catalog.fixture import Fixture
from eavista.functions import ages, clinical, text
from eavista.operators import joins, latest, migrate
from eavista.operators.filters import in_date_range, overlay, patient_or_range
from eavista.operators.latest import carry_forward, latest_per_key, newest, number_rows
from eavista.operators.lookups import Dictionary, latest_names
from eavista.operators.obs import Measure, measures, pivot_obs, repeated_children
from eavista.plans import REPORTS, note
from eavista.plans.report import nested
from eavista.session import literal_table
from eavista.sources import dictionaries, sites
from tests.compare import SF_DIR

OBS = ("obs_id bigint, obs_group_id bigint, encounter_id bigint, concept_id int, value_numeric double, "
       "value_coded int, value_text string")


def one(spark, *columns):
    return list(spark.range(1).select(*columns).first())


def lit_date(day):
    return F.lit(day).cast("date")


# --- texts and numbers --------------------------------------------------------


@pytest.mark.parametrize("surname, expected", [
    ("Núñez López", ["Núñez", "López"]),
    ("López", ["López", None]),
    ("de la Cruz Díaz", ["de", "la Cruz Díaz"]),
])
def test_surnames(spark, surname, expected):
    name = F.lit(surname)
    assert one(spark, text.paternal_surname(name), text.maternal_surname(name)) == expected


@pytest.mark.parametrize("place", ["Matazano ", "MATAZANO", "matazáno"])
def test_recode_is_loose(spark, place):
    assert one(spark, text.recode(F.lit(place), values.NOTE_FACILITIES)) == ["Casa de salud El Matasanos"]


def test_recode_default(spark):
    unknown = F.lit("pediatria x")
    assert one(spark, text.recode(unknown, values.NOTE_FACILITIES, unknown)) == ["pediatria x"]
    assert one(spark, text.recode(unknown, values.HISTORY_FACILITIES)) == [None]


def test_blood_pressure(spark):
    rows = spark.createDataFrame([(120.0, None), (None, 80.0), (120.0, 80.5)], "s double, d double")
    shown = [r[0] for r in rows.select(clinical.blood_pressure_text("s", "d")).collect()]
    assert shown == [None, "", "120/80.5"]


def test_bmi(spark):
    got = one(spark, clinical.bmi(F.lit(70.0), F.lit(175.0)), clinical.bmi(F.lit(70.0), F.lit(0.0)),
              clinical.bmi(F.lit(None).cast("double"), F.lit(170.0)))
    assert got == [22.9, None, None]


@pytest.mark.parametrize("baseline, current, expected", [(10.9, 3.2, 70), (0.5, 1.0, None), (8.0, 9.0, -12)])
def test_percent_reduction(spark, baseline, current, expected):
    assert one(spark, clinical.percent_reduction(F.lit(baseline), F.lit(current))) == [expected]


def plain_wrap(content, width):
    lines, line = [], ""
    for word in content.split(" "):
        longer = word if line == "" else f"{line} {word}"
        if len(longer) > width:
            lines.append(line)
            line = word
        else:
            line = longer
    return lines + [line] if line else lines


def test_wrap_words(spark):
    rng = random.Random(7)
    texts = ["", "a", " ", "toolongword short", "a  b", "x" * 30] + [
        " ".join("y" * rng.randint(0, 9) for _ in range(rng.randint(1, 60))) for _ in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for width in (5, 12):
        got = {r["i"]: r["lines"] for r in df.select("i", text.wrap_words(F.col("t"), width).alias("lines")).collect()}
        assert got == {i: plain_wrap(t, width) for i, t in enumerate(texts)}


def test_dose_text(spark):
    names = ["dose_1", "dose_1_units", "dose_1_morning", "dose_1_noon", "dose_1_afternoon", "dose_1_evening"]
    schema = T.StructType([T.StructField(n, T.DoubleType() if n == "dose_1" else T.StringType()) for n in names])
    rows = spark.createDataFrame([(2.0, "tab", "1", None, "2", None), (None, "tab", "1", None, None, None)], schema)
    shown = [r[0] for r in rows.select(note.dose_text(1)).collect()]
    assert shown == ["Dosis 1: 2 tab, Mañana: 1, Tarde: 2", None]


# --- dates --------------------------------------------------------------------


@pytest.mark.parametrize("born, on, years", [
    ("2000-02-29", "2021-02-28", 20), ("2000-02-29", "2021-03-01", 21), ("1990-05-05", "2020-05-05", 30)])
def test_full_years(spark, born, on, years):
    assert one(spark, ages.full_years(lit_date(born), lit_date(on))) == [years]


def test_months_and_days(spark):
    born, on = lit_date("2000-01-31"), lit_date("2001-03-15")
    assert one(spark, ages.months_after_year(born, on), ages.days_after_month(born, on)) == [1, 15]


def test_gestational_age(spark):
    parts = ages.gestational_age(lit_date("2024-01-01"), lit_date("2024-01-22"))
    got = one(spark, *parts.values())
    assert got[:4] == [21, 3, 0, "3  semanas"] and str(got[4]) == "2024-10-07"


def test_date_range_is_pushed_down(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    rows = in_date_range(orders, "o_orderdate", "1996-01-01", "1996-01-31").select("o_orderkey")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_patient_beats_range(spark):
    rows = spark.sql("SELECT id AS patient_id, timestamp_ntz'2020-01-01 10:00:00' AS at FROM range(3)")
    assert patient_or_range(rows, "at", "1990-01-01", "1990-01-02", patient_id=2).count() == 1
    assert patient_or_range(rows, "at", "2020-01-01", "2020-01-01").count() == 3


def test_overlay_last_wins(spark):
    shown = overlay((F.lit(True), F.lit("a")), (F.lit(True), F.lit("b")), (F.lit(False), F.lit("c")))
    assert one(spark, shown) == ["b"]


# --- keys, windows, joins -------------------------------------------------------


def test_latest_name_tie(spark):
    rows = spark.createDataFrame(
        [(1, 9, "a", 1, 5, 0), (2, 9, "b", 1, 5, 0), (3, 9, "c", 1, 9, 1), (4, 9, "d", 0, 9, 0)],
        "person_name_id int, person_id int, given_name string, preferred int, date_created int, voided int")
    assert [r["given_name"] for r in latest_names(rows).collect()] == ["b"]


def test_latest_keeps_one_row_per_key_before_the_shuffle(spark):
    rows = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    latest = latest_per_key(rows, "o_custkey", *newest("o_orderdate", "o_orderkey"))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_number_rows_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [(i, 0 if i % 3 else rng.randint(-5, 5)) for i in range(5000)]
    df = spark.createDataFrame(rows, "id int, at int")
    got = {r["id"]: r["n"] for r in number_rows(df, "n", "at", "id", after=100).collect()}
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    assert got == {r[0]: 101 + i for i, r in enumerate(ordered)}


@pytest.mark.parametrize("n", [0, 1, 3, 4000])
def test_numbers_of_any_order(spark, n):
    """Nulls first, texts, decimals and times as order columns; few rows and none."""
    df = spark.range(n).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("é"), F.col("id") % 5)).alias("name"),
        F.when(F.col("id") % 7 > 0, F.timestamp_seconds(F.col("id") % 11)).alias("at"),
        (F.col("id") * -1).cast("decimal(20,2)").alias("id"),
    )
    found = [r.n for r in number_rows(df, "n", "name", "at", "id").orderBy("name", "at", "id").collect()]
    assert found == list(range(1, n + 1))


def test_numbers_are_the_same_in_every_run_and_nothing_is_written(spark, monkeypatch):
    """Rows placed otherwise by another run give the same numbers, and parts are of about equal size."""
    monkeypatch.setattr(DataFrame, "checkpoint", None)
    n, parts = 20_000, int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(n).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 50).alias("at"), "id")
    again = rows.repartition(5, F.rand(1))
    numbers = [{r.id: r.n for r in number_rows(df, "n", "at", "id").collect()} for df in (rows, again)]
    assert numbers[0] == numbers[1] and sorted(numbers[0].values()) == list(range(1, n + 1))
    sizes = [r["count"] for r in latest.with_part(rows, ("at", "id"), parts).groupBy("_part").count().collect()]
    assert len(sizes) == parts and max(sizes) < 1.7 * n / parts


def test_carry_forward(spark):
    rng = random.Random(2)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rng.randint(1, 20)
        rows.append((key, rng.randint(0, 10 * 86400), i, rng.randint(1, 9) if rng.random() < 0.1 else None))
    df = spark.createDataFrame(rows, "key int, s bigint, id int, value int").withColumn(
        "at", F.timestamp_seconds("s"))
    got = {r["id"]: r["carried"] for r in carry_forward(df, "key", "at", "id", "value", "carried").collect()}
    expected, last = {}, {}
    for key, _, i, value in sorted(rows, key=lambda r: (r[1], r[2])):
        last[key] = value if value is not None else last.get(key)
        expected[i] = last[key]
    assert got == expected


def test_null_groups_do_not_match(spark):
    rows = [(1, None, 7, 101, 2.0, None, None), (2, None, 7, 106, None, None, None),
            (3, 50, 7, 101, 3.0, None, None)]
    obs = spark.createDataFrame(rows, OBS)
    seeds = obs.filter("concept_id = 106")
    assert [r["obs_id"] for r in joins.related_obs(obs, seeds).collect()] == [2]
    grouped = pivot_obs(obs, "obs_group_id", [Measure("q", 101)]).collect()
    assert [(r["obs_group_id"], r["q"]) for r in grouped] == [(50, 3.0)]


def test_left_lookup_keeps_rows_without_key(spark):
    left = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "id bigint, fk bigint")
    table = spark.createDataFrame([(5, "five"), (0, "zero")], "k bigint, name string")
    got = {r["id"]: r["name"] for r in joins.left_lookup(left, table, "fk", "k", "id").collect()}
    assert got == {1: None, 2: "five", 3: None}


def test_similar_records_equal_brute_force(spark):
    """One value of every field is held by a third of the records."""
    rng = random.Random(3)
    fields = list(values.SIMILARITY_WEIGHTS)

    def value(n):
        return None if rng.random() < 0.15 else "hot" if rng.random() < 0.35 else f"v{rng.randint(0, n)}"

    rows = [(i, value(3), value(6), value(20), value(25), value(40)) for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, " + ", ".join(f"{f} string" for f in fields))
    got = defaultdict(list)
    for r in joins.similar_records(df, "id", values.SIMILARITY_WEIGHTS, 4).collect():
        got[r["id"]].append((r["rank"], r["similar_id"], r["score"]))
    weights = list(values.SIMILARITY_WEIGHTS.values())
    for a in rows:
        scored = []
        for b in rows:
            score = sum(w for w, x, y in zip(weights, a[1:], b[1:]) if x is not None and x == y)
            if a[0] != b[0] and score:
                scored.append((-score, b[0]))
        expected = [(n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:4])]
        assert sorted(got[a[0]]) == expected


def test_superseded_equals_both_conditions(spark):
    rng = random.Random(4)
    rows = [(i, rng.randint(0, 40), rng.randint(0, i) if i and rng.random() < 0.6 else None) for i in range(300)]
    obs = spark.createDataFrame(rows, "obs_id bigint, encounter_id bigint, previous_version bigint")
    encounters = spark.range(50).withColumnRenamed("id", "encounter_id")
    both = joins.encounters_fully_replaced(encounters, obs).join(
        joins.encounters_replaced_elsewhere(obs), "encounter_id", "left_semi")
    one_pass = joins.superseded_encounters(encounters, obs)
    assert sorted(r[0] for r in one_pass.collect()) == sorted(r[0] for r in both.collect())


# --- observations ---------------------------------------------------------------


def test_pivot_equals_one_join_per_column(spark):
    fx = Fixture.of(spark, SF_DIR)
    obs = fx.obs.filter("voided = 0").filter("encounter_id < 2000")
    wanted = [Measure("q", 101), Measure("p", 102), Measure("n", 107, "text"), Measure("d", 105, "date")]
    wide = pivot_obs(obs, "encounter_id", wanted)
    joined = obs.filter("concept_id IN (101, 102, 105, 107)").select("encounter_id").distinct()
    for m in wanted:
        joined = joined.join(pivot_obs(obs, "encounter_id", [m]), "encounter_id", "left")
    assert sorted(wide.collect()) == sorted(joined.collect())


def test_wide_pivot_equals_narrow_pivot(spark):
    """Above the limit the numbers and texts are pivoted apart."""
    clinic = Fixture.of(spark, SF_DIR).clinic
    obs = clinic["obs"].filter("voided = 0")
    wanted = measures(values.HISTORY_MEASURES)
    wide = pivot_obs(obs, "encounter_id", wanted, clinic.dictionary)
    for column in ("gravida", "housing", "lmp_date", "fp_method"):
        m = next(m for m in wanted if m.column == column)
        narrow = pivot_obs(obs, "encounter_id", [m], clinic.dictionary).filter(F.col(column).isNotNull())
        assert wide.filter(F.col(column).isNotNull()).select("encounter_id", column).exceptAll(narrow).isEmpty()
        assert narrow.exceptAll(wide.select("encounter_id", column)).isEmpty()


def test_pivot_has_one_shuffle(spark):
    obs = spark.createDataFrame([(1, 5, 7, 101, 2.0, None, "x")], OBS)
    wanted = [Measure("a", 101), Measure("b", 102), Measure("c", 103, "text")]
    plan = pivot_obs(obs, "encounter_id", wanted)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def dictionary(spark):
    mapping = literal_table(spark, "concept_id int, source string, code string",
                            [(1, "LOCAL", "Diagnosis"), (2, "CIEL", "21"), (4, "LOCAL", "DIAGNOSIS")])
    names = literal_table(
        spark, "concept_name_id int, concept_id int, name string, locale string, concept_name_type string, "
        "locale_preferred int, voided int",
        [(1, 1, "en", "en", None, 1, 0), (2, 1, "es b", "es", None, 0, 0), (3, 1, "es a", "es", None, 1, 0),
         (4, 2, "only en", "en", None, 0, 0), (5, 2, "short", "es", "SHORT", 0, 0), (6, 2, "gone", "es", None, 1, 1)])
    return Dictionary(mapping, names)


def test_dictionary(spark):
    d = dictionary(spark)
    found = {r["role"]: r["concept_id"] for r in d.resolve({"dx": "DIAGNOSIS", "hb": "CIEL:21", "x": "none"}).collect()}
    assert found == {"dx": 1, "hb": 2}
    assert [r["role"] for r in d.unresolved({"dx": "diagnosis", "x": "none"}).collect()] == ["x"]
    assert {r["concept_id"]: (r["name"], r["short_name"]) for r in d.best_names().collect()} == {
        1: ("es a", None), 2: ("only en", "short")}


def test_incomplete_items(spark):
    clinic = Fixture.of(spark, SF_DIR).clinic
    obs = clinic["obs"].filter("voided = 0")
    strict = note.coded_diagnosis_lists(clinic, obs).filter("diagnoses IS NOT NULL").count()
    loose = note.coded_diagnosis_lists(clinic, obs, keep_incomplete=True).filter("diagnoses IS NOT NULL").count()
    assert strict < loose


def test_single_patient_report(spark):
    clinic = Fixture.of(spark, SF_DIR).clinic
    rows = REPORTS["clinical_history"].run(clinic, patient_id=3)["histories"]
    ids = {r["encounter_id"] for r in rows.collect()}
    expected = {r[0] for r in clinic.encounters(values.CLINICAL_HISTORY, patient_id=3).select("encounter_id").collect()}
    assert ids == expected and ids
    assert all("-" != r["sheet_name"][0] and r["sheet_name"][:2].isdigit() for r in rows.collect())
    with pytest.raises(ValueError):
        REPORTS["clinical_note"].run(clinic, patient_id=3)


def test_repeated_children(spark):
    rows = [(1, 7, 1, 4, None, None, None), (2, 7, 1, 4, None, None, None), (3, 8, 1, 4, None, None, None)]
    mapping = literal_table(spark, "concept_id int, source string, code string", [(4, "LOCAL", values.MEDICATION)])
    found = repeated_children(spark.createDataFrame(rows, OBS), Dictionary(mapping, dictionary(spark).names))
    assert [(r["obs_group_id"], r["occurrences"]) for r in found.collect()] == [(7, 2)]


def test_voided_rows_count_only_on_request(spark):
    clinic = Fixture.of(spark, SF_DIR).clinic
    total = lambda **options: REPORTS["meds_dispensed"].run(
        clinic, "1995-01-01", "2001-12-31", **options)["meds"].agg(F.sum("Cantidad")).first()[0]
    assert total() < total(include_voided=True)


# --- migrations -----------------------------------------------------------------


def test_migration_runs_once(spark):
    rows = [(1, 203, 0, "u1", None, None, None, "FINAL"), (2, 203, 1, "u2", None, None, None, "FINAL"),
            (3, 201, 0, "u3", None, None, None, "FINAL")]
    obs = spark.createDataFrame(
        rows, "obs_id bigint, value_coded int, voided int, uuid string, date_voided timestamp, void_reason string, "
        "previous_version bigint, status string")
    now = F.lit("2026-01-01").cast("timestamp")
    first = migrate.recode_obs(obs, 203, 202, now)
    again = migrate.recode_obs(first, 203, 202, now)
    assert first.count() == 4 and again.exceptAll(first).isEmpty() and first.exceptAll(again).isEmpty()
    copy = first.filter("previous_version = 1").first()
    assert (copy["obs_id"], copy["value_coded"], copy["voided"], copy["status"]) == (4, 202, 0, "AMENDED")
    assert len(copy["uuid"]) == 36


# --- sources and sinks ------------------------------------------------------------


def test_multi_value_cell(spark):
    names = ["uuid", "Mappings|SAME-AS|CIEL", "Mappings|NARROWER-THAN|Y 2nd"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = spark.createDataFrame([("u", "6039;620", None)], schema)
    got = sorted((r["relation"], r["source"], r["code"]) for r in dictionaries.unpivot_mappings(df).collect())
    assert got == [("SAME-AS", "CIEL", "6039"), ("SAME-AS", "CIEL", "620")]


def test_locations(spark):
    names = ["UUID", "Name", "Description", "Parent", "Tag|Visit Location", "Tag|Vitals Location"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = [("u1", "Chiapas", None, None, "TRUE", None), ("u2", "Reforma", None, "Chiapas", "TRUE", "TRUE")]
    places, tags = dictionaries.locations(spark.createDataFrame(rows, schema))
    assert {r["uuid"]: r["parent_uuid"] for r in places.collect()} == {"u1": None, "u2": "u1"}
    assert sorted(map(tuple, tags.collect())) == [
        ("u1", "Visit Location"), ("u2", "Visit Location"), ("u2", "Vitals Location")]


def test_closure_with_a_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 9)], "s int, m int")
    got = {(r["root"], r["member"]) for r in dictionaries.set_closure(edges, "s", "m").collect()}
    assert {(1, 2), (1, 3), (1, 9), (2, 9), (3, 9), (2, 1), (3, 1)} <= got


def test_missing_required_level(spark):
    lines = spark.createDataFrame([("Chiapas|Montecristo|x",), ("Chiapas",), ("Chiapas| |x",)], "line string")
    assert dictionaries.missing_required_levels(lines, "line").count() == 2


def test_constants_are_flattened():
    assert dictionaries.flatten_constants({"a": {"b": {"uuid": 1}}, "c": "d"}) == [("a.b.uuid", "1"), ("c", "d")]


def test_declared_schema_needs_all_columns(spark):
    with pytest.raises(ValueError, match="encounter_type"):
        sites.with_declared_schema(spark.sql("SELECT 1 AS patient_id, 2 AS encounter_id"), sites.ENCOUNTER_EXTRACT)


def _parts(rows, points):
    conditions = sites.split_predicates("id", points)
    met = rows.select("id", *[F.coalesce(F.expr(c), F.lit(False)).cast("int").alias(f"p{i}") for i, c in enumerate(conditions)])
    assert met.filter(sum((F.col(f"p{i}") for i in range(len(conditions))), F.lit(0)) != 1).isEmpty()
    return [r for r in met.agg(*[F.sum(f"p{i}") for i in range(len(conditions))]).first()]


def test_split_predicates_are_disjoint_complete_and_balanced(spark, tmp_path):
    """Ids that lie close together at one end, with gaps; even ranges would put nearly all rows in one part."""
    path = str(tmp_path / "encounter")
    spark.range(20_000).select(F.when(F.col("id") < 19_000, F.col("id")).otherwise(F.col("id") * 1_000_003).alias("id")).write.parquet(path)
    rows = spark.read.parquet(path)
    points = sites.split_points(rows, "id", 16)
    sizes = _parts(rows, points)
    assert len(sizes) == 16 and sum(sizes) == 20_000 and max(sizes) <= 1.05 * 20_000 / 16
    # null, older and newer ids than the points know
    grown = rows.unionByName(spark.createDataFrame([(None,), (-5,), (10**15,)], "id bigint"))
    assert sum(_parts(grown, points)) == 20_003
    pushed = rows.filter(sites.split_predicates("id", points)[3])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id" in pushed


def test_split_predicates_of_odd_tables(spark):
    none = spark.createDataFrame([], "id bigint")
    assert sites.split_predicates("id", sites.split_points(none, "id", 8)) == ["1 = 1"]
    same = spark.createDataFrame([(7,)] * 50, "id bigint")
    assert sites.split_points(same, "id", 8) == [7] and _parts(same, [7]) == [0, 50]
    assert sites.split_points(same, "id", 1) == []


def test_unknown_site(spark):
    with pytest.raises(ValueError):
        sites.consolidate({"nowhere": spark.range(1)})


def test_overwrite_touches_one_partition(spark, tmp_path):
    path = str(tmp_path / "w")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (51, "c")], "v int, x string")
    table = rows.withColumn("partition_num", sites.range_partition(F.col("v") + 10))
    sites.overwrite_partitions(table, path)
    sites.overwrite_partitions(table.filter("partition_num = 12").withColumn("x", F.lit("new")), path)
    assert {(r["partition_num"], r["x"]) for r in spark.read.parquet(path).collect()} == {
        (11, "a"), (12, "new"), (51, "c")}


def test_nested_document(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    child = spark.createDataFrame([(1, 9, "b"), (1, 3, "a")], "k int, n int, x string")
    got = {r["k"]: [(c["n"], c["x"]) for c in r["lines"]] for r in nested(parent, child, "k", "lines", "n").collect()}
    assert got == {1: [(3, "a"), (9, "b")], 2: []}
