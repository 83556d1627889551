"""Tables of many lines: observations are derived as they are read, not written, and the same."""

import pytest
from pyspark.sql import functions as F

from eavista import values
from eavista.catalog import fixture, joins as join_queries
from eavista.catalog.fixture import Fixture, cid
from eavista.operators import joins, latest, naming
from eavista.operators.lookups import Dictionary
from eavista.operators.obs import medication_lines
from eavista.session import scratch
from tests.compare import SF_DIR


@pytest.fixture
def many(spark, monkeypatch):
    monkeypatch.setattr(fixture, "STORED_LINES", 0)
    return Fixture(spark, SF_DIR)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_observations_of_many_lines_are_not_written(spark, many):
    derived, stored = many.clinic["obs"], Fixture.of(spark, SF_DIR).clinic["obs"]
    assert not [name for name in many._paths if name == "fx_clinic_obs"] and "fx_lines" in many._paths
    assert derived.columns == stored.columns
    assert derived.exceptAll(stored).isEmpty() and stored.exceptAll(derived).isEmpty()


def test_lines_meet_their_encounters_where_they_lie(many, no_broadcast):
    keys = many.clinic.encounters(values.VITALS)
    plan = _plan(many.view("fx_lines").join(keys, F.col("l_orderkey") == F.col("encounter_id"), "left_semi"))
    assert "SortMergeJoin [l_orderkey" in plan and "Bucketed: true" in plan
    assert "hashpartitioning(l_orderkey" not in plan


def test_removed_lines_are_written_again(spark, many):
    with scratch(spark):
        assert not many.clinic["obs"].isEmpty()
    assert not many.clinic["obs"].isEmpty()


def test_bucketed_table_has_what_the_pivot_reads(many):
    stored = many.bucketed_obs()
    wanted = {cid(code) for _, code, _ in values.VITALS_MEASURES}
    assert {r[0] for r in stored.select("concept_id").distinct().collect()} <= wanted
    assert "date_created" not in stored.columns


def test_rows_with_a_seeds_id_are_related(spark):
    """Groups over several rows, a group without a seed, seeds without a group, and an id that repeats."""
    rows = [(1, 50, 1), (2, 50, 2), (3, 60, 2), (4, None, 1), (4, None, 2), (5, None, 2), (6, 70, 1), (7, 70, 1)]
    obs = spark.createDataFrame(rows, "obs_id bigint, obs_group_id bigint, concept_id int")
    found = joins.related_obs(obs, obs.filter("concept_id = 1"))
    assert sorted(r.obs_id for r in found.collect()) == [1, 2, 4, 4, 6, 7]


def test_many_observations_are_not_sorted_for_a_few_ids(spark, no_broadcast):
    plan = _plan(join_queries.semi_join_in(Fixture.of(spark, SF_DIR)))
    assert "ShuffledHashJoin" in plan


def test_parts_are_found_in_generated_code(spark):
    """Every number of parts and rows: a part is the number of bounds below the row's key."""
    for rows, parts in ((0, 2), (1, 2), (7, 8), (300, 5), (1000, 48)):
        df = spark.range(rows).select((F.col("id") * 37 % 1009).alias("n"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("m"))
        placed = latest.with_part(df, ["m", "n"], parts)
        assert "aggregate(" not in _plan(placed) and placed.columns == ["n", "m", "_part"]
        bounds = [tuple(b) for b in df.select(latest._bounds(df, ["m", "n"], parts).alias("b")).first().b or []] if rows else []
        low = lambda r: (r[0] is not None, r[0] or 0, r[1])
        for r in placed.collect():
            assert r._part == sum(low(b) < low((r.m, r.n)) for b in bounds)


def many_medications(spark):
    """Groups with and without children, without a drug, with an unknown answer, a null group, and a group id that repeats."""
    parts = list(values.PARTS_OF_DAY.values())
    codes = list(dict.fromkeys([values.MEDICATION_GROUP, *[m[1] for m in values.MEDICATION_MEASURES], *parts]))
    ids = {code: 100 + n for n, code in enumerate(codes)}
    mapping = [(ids[c], *Dictionary(None, None).split(c)) for c in codes]
    names = [(n, f"n{n}", "es", 1, n * 2, "FULLY_SPECIFIED", 0) for n in range(300, 320)]
    names += [(n, f"s{n}", "es", 0, n * 2 + 1, "SHORT", 0) for n in range(300, 320, 2)]
    obs = [(n, None, n, ids[values.MEDICATION_GROUP], None, None, None) for n in (*range(1, 30), 7)]
    for g in (*range(1, 25), None, 99):
        at = 1000 + (g or 50) * 20
        obs += [(at, g, 1, ids[values.MEDICATION], None, None, None if (g or 0) % 5 == 0 else (g or 0) % 9),
                (at + 1, g, 1, ids["TIME UNITS"], None, 300 + (g or 0) % 2, None),
                (at + 2, g, 1, ids["Dosing units coded"], None, 302 if (g or 0) % 3 else 900, None),
                (at + 3, g, 1, ids["9075"], float(at), None, None)]
    obs = spark.createDataFrame(obs, "obs_id bigint, obs_group_id bigint, encounter_id bigint, concept_id int, "
                                     "value_numeric double, value_coded int, value_drug bigint")
    for column in ("value_text", "comments"):
        obs = obs.withColumn(column, F.lit(None).cast("string"))
    mapping = spark.createDataFrame(mapping, "concept_id int, source string, code string")
    names = spark.createDataFrame(names, "concept_id int, name string, locale string, locale_preferred int, "
                                         "concept_name_id int, concept_name_type string, voided int")
    drugs = spark.range(8).select(F.col("id").alias("drug_id"), F.concat(F.lit("d"), "id").alias("name"))
    return obs, Dictionary(mapping, names), drugs


def test_medication_lines_meet_their_group_before_their_names(spark, no_broadcast, monkeypatch):
    """Rows of a large dictionary are moved by their group and by their drug only, and get the names as before."""
    obs, dictionary, drugs = many_medications(spark)
    wanted = sorted(map(tuple, medication_lines(obs, dictionary, drugs).collect()), key=str)
    monkeypatch.setattr(naming, "INDEXED", 4)
    found = medication_lines(obs, Dictionary(dictionary.mapping, dictionary.names, dictionary.local_source), drugs)
    plan = _plan(found)
    assert plan.count("BroadcastHashJoin") >= 3
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(coalesce(" in line]
    assert len(moved) == 1 and "value_drug" not in moved[0]
    assert sorted(map(tuple, found.collect()), key=str) == wanted
    monkeypatch.setattr(naming, "INDEXED", 1)
    many = medication_lines(obs, Dictionary(dictionary.mapping, dictionary.names, dictionary.local_source), drugs)
    assert sorted(map(tuple, many.collect()), key=str) == wanted


def test_rows_of_a_large_dictionary_stay_where_they_are(spark, no_broadcast, monkeypatch):
    """Few names in use are sent to the rows; no copies of the whole dictionary, and no rows, are shuffled."""
    answers = [None if n % 7 == 0 else 300 + n % 5 for n in range(100)]
    rows = spark.createDataFrame(list(enumerate(answers)), "obs_id bigint, value_coded int")
    names = spark.createDataFrame([(n, f"n{n}") for n in range(301, 330)], "concept_id int, name string")
    wanted = [(n, a, f"n{a}" if a and a > 300 else None) for n, a in enumerate(answers)]
    for indexed, moved in ((5, False), (4, True)):
        monkeypatch.setattr(naming, "INDEXED", indexed)
        found = naming.with_name(rows, "value_coded", names, "concept_id", "name", "shown", "obs_id")
        assert ("_salt" in _plan(found)) == moved and ("SortMergeJoin" in _plan(found)) == moved
        assert sorted(map(tuple, found.collect())) == wanted
