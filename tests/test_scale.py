"""What the plans and staged tables look like: one shuffle of observations, ranges first, nothing left over."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eavista.catalog.fixture import SPARK_KEY, Fixture
from eavista.operators import joins, lookups, migrate, obs as obs_operators
from eavista.operators.lookups import Dictionary
from eavista.plans import diagnoses, history, note, prescriptions, registration, visits, vitals
from eavista.session import checkpoint, scratch, shared_dir, stage
from eavista.sources import dictionaries, sites
from tests.compare import SF_DIR


@pytest.fixture(scope="module")
def clinic(spark):
    return Fixture.of(spark, SF_DIR).clinic


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _children(node):
    if node.nodeName() == "AdaptiveSparkPlan":
        return [node.initialPlan()]
    return [node.children().apply(i) for i in range(node.children().size())]


def _path_to(node, wanted):
    """Nodes from the leaf that ``wanted`` accepts up to ``node``."""
    children = _children(node)
    if not children and wanted(node):
        return [node]
    for child in children:
        if path := _path_to(child, wanted):
            return [*path, node]
    return []


def _observations(df):
    """Exchanges between the observation scan and the complete aggregate above it, and the scan."""
    path = _path_to(df._jdf.queryExecution().executedPlan(), lambda n: "fx_clinic_obs" in n.toString())
    names = [n.nodeName() for n in path]
    last = [i for i, n in enumerate(names) if n.endswith("Aggregate")][1]
    return names[:last].count("Exchange"), path[0].verboseStringWithOperatorId()


@pytest.mark.parametrize("key", ["report_vitals", "obs_pivot_wide"])
def test_pivot_shuffles_observations_once(spark, no_broadcast, key):
    import __spark_entry__ as entry

    exchanges, scan = _observations(entry.queries()[key](spark, SF_DIR))
    assert exchanges == 1
    assert "In(concept_id" in scan


def test_one_day_stages_one_days_observations(spark, clinic, monkeypatch):
    staged = []
    keep = lambda df, name: staged.append(df) or df
    for module in (diagnoses, visits):
        monkeypatch.setattr(module, "staged_obs", keep)
    day = str(clinic["encounter"].filter("voided = 0").agg(F.min("encounter_datetime")).first()[0])[:10]
    inside = clinic.encounters(None, day, day).select("encounter_id")
    diagnoses.diagnoses(clinic, day, day)
    visits.visit_diagnoses(clinic, day, day)
    visits.epidemiology(clinic, day, day)
    assert len(staged) == 3
    for rows in staged:
        assert rows.join(inside, "encounter_id", "left_anti").isEmpty()
        assert rows.select("concept_id").distinct().count() <= 4


def test_hot_id_is_dealt_to_many_tasks(spark, no_broadcast):
    """Nine tenths of the rows name one id: no task holds more than a small multiple of the mean."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(20_000).select("id", F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id") % 50).alias("place"))
        places = spark.range(50).select(F.col("id").alias("p"), F.concat(F.lit("n"), "id").alias("name"))
        found = joins.left_lookup(rows, places, "place", "p", "id", joins.FEW_IDS)
        sizes = [r[0] for r in found.groupBy(F.spark_partition_id()).agg(F.count("*")).select("count(1)").collect()]
        assert found.filter("name <> concat('n', place)").isEmpty() and sum(sizes) == 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(sizes) <= 4 * 20_000 / 8


def test_scratch_leaves_nothing(spark):
    folder = Path(shared_dir(spark).removeprefix("file:"))
    with scratch(spark):
        rows = stage(spark.range(5).toDF("n"), "scratch-test")
        assert rows.count() == 5 and list(folder.glob("scratch-test-*"))
    assert not list(folder.glob("scratch-test-*"))


def test_closure_has_no_row_limit(spark):
    """Chains of diamonds have few pairs and very many paths."""
    edges = [(f"s{i}", f"{side}{i}") for i in range(30) for side in "ab"]
    edges += [(f"{side}{i}", f"s{i + 1}") for i in range(30) for side in "ab"]
    edges += [(f"s{i}", f"leaf{j}") for i in (0, 30) for j in range(1500)] + [("s30", "s0")]
    frame = spark.createDataFrame(edges, "parent string, child string")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "1000")
    try:
        rows = dictionaries.set_closure(frame, "parent", "child", F.lit("s0")).collect()
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
    found = {r.member: (r.depth, r.leaf) for r in rows}
    assert len(rows) == len(found) == 90 + 1500
    assert found["s30"] == (60, False) and found["leaf7"] == (1, True) and "s0" not in found


def test_closure_rounds_grow_with_the_logarithm(spark, monkeypatch):
    """A chain of 1,000 sets, with shortcuts, a loop back, leaves and links without an end."""
    rounds = []
    monkeypatch.setattr(dictionaries, "checkpoint", lambda df: rounds.append(1) or checkpoint(df))
    edges = [(f"s{i}", f"s{i + 1}") for i in range(999)] + [(f"s{i}", f"leaf{i % 40}") for i in range(0, 1000, 90)]
    edges += [("s5", "s300"), ("s999", "s0"), ("s7", "s7"), ("s8", None), (None, "s9")]
    frame = spark.createDataFrame(edges, "parent string, child string")
    rows = dictionaries.set_closure(frame, "parent", "child", F.lit("s0")).collect()
    assert len(rounds) <= 2 + 11
    ways, found, depth, ring = {}, {}, 0, ["s0"]
    for a, b in edges:
        if a and b:
            ways.setdefault(a, []).append(b)
    while ring:
        depth += 1
        ring = [m for m in dict.fromkeys(b for a in ring for b in ways.get(a, [])) if m not in found and m != "s0"]
        found.update(dict.fromkeys(ring, depth))
    assert {r.member: (r.depth, r.leaf) for r in rows} == {m: (d, m not in ways) for m, d in found.items()}
    assert len(rows) == len(found) and max(found.values()) > 600


def test_closure_of_every_set(spark):
    frame = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "x"), ("b", "x"), ("d", "d"), ("c", "a")], "p string, c string")
    rows = {(r.root, r.member): (r.depth, r.leaf) for r in dictionaries.set_closure(frame, "p", "c").collect()}
    assert rows == {
        ("a", "b"): (1, False), ("a", "c"): (2, False), ("a", "x"): (2, True), ("b", "c"): (1, False), ("b", "a"): (2, False),
        ("b", "x"): (1, True), ("c", "a"): (1, False), ("c", "b"): (2, False), ("c", "x"): (1, True), ("d", "d"): (1, False),
    }
    assert dictionaries.set_closure(frame.filter("false"), "p", "c").isEmpty()


def test_similar_records_of_one_large_group(spark, no_broadcast, monkeypatch):
    """Nine tenths of the records share a value: their candidates are met in many tasks, and found alike."""
    n = 20_000
    rows = spark.range(n).select(
        "id", F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 500)).alias("town"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("t"), F.col("id") % 3000)).alias("phone"),
    )
    weights = {"town": 1, "phone": 20}
    plain = joins.similar_records(rows, "id", weights, 3).collect()
    monkeypatch.setattr(joins, "SMALL_TABLE", 1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dealt = joins.similar_records(rows, "id", weights, 3)
        assert sorted(dealt.collect()) == sorted(plain)
        keyed = rows.select(F.col("id").alias("_id"), F.lit(1).alias("_mask"), F.col("town").alias("_key"))
        parts = joins._dealt(keyed, joins._large_groups(keyed, F.lit(n)))
        sizes = [r["count"] for r in parts.repartition(8, "_mask", "_key", "_part").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == n and max(sizes) <= 2 * n / 8


def test_line_ids_at_hundredfold_keys(spark):
    """Keys as large as in 100 times the largest test tables neither overflow nor collide."""
    n = 300_000
    keys = spark.range(n).select(
        (F.lit(60_000_000) - F.col("id")).alias("o"), (F.col("id") % 7 + 1).alias("l"),
        (F.lit(20_000_000) + F.col("id") % 1000).alias("p"), (F.lit(1_000_000) + F.col("id") % 10).alias("s"),
    )
    import re

    key = re.sub(r"@key\(([^)]*)\)", SPARK_KEY, "@key(o, l, p, s)")
    ids = keys.select((F.expr(key) * 100 + 93).alias("id"))
    assert ids.distinct().count() == n and ids.filter("id < 0").isEmpty()


def test_copies_of_voided_rows_are_live(spark):
    rows = spark.createDataFrame(
        [(1, 5, 1, "u1", "2020-01-01", "wrong", 9, None, "FINAL"), (2, 5, 0, "u2", None, None, None, None, "FINAL")],
        "obs_id bigint, value_coded int, voided int, uuid string, date_voided string, void_reason string, "
        "voided_by bigint, previous_version bigint, status string",
    )
    done = migrate.recode_obs(rows, 5, 6, F.lit("now"), include_voided=True).collect()
    copies = [r for r in done if r.value_coded == 6]
    assert len(copies) == 2
    assert all((r.voided, r.date_voided, r.void_reason, r.voided_by) == (0, None, None, None) for r in copies)


def test_a_change_that_is_not_due_is_not_built(spark):
    rows = spark.range(3).toDF("n")
    assert migrate.run_guarded(rows, rows, lambda df: pytest.fail("built")).count() == 3


def test_emptied_partition_is_replaced(spark, tmp_path):
    path = str(tmp_path / "sites")
    rows = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "n int, partition_num int")
    sites.overwrite_partitions(rows, path)
    sites.overwrite_partitions(rows.filter("n = 1"), path, loaded=(1, 2))
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, 1), (3, 3)]


def test_codes_are_read_once_and_doubtful_ones_reported(spark):
    mapping = spark.createDataFrame(
        [(1, "LOCAL", "A"), (2, "LOCAL", "b"), (3, "LOCAL", "B")], "concept_id int, source string, code string")
    dictionary = Dictionary(mapping, None)
    assert dictionary.ids(["a", "B", "none"]) == {"a": 1, "B": 2, "none": None}
    assert [r.role for r in dictionary.ambiguous({"x": "a", "y": "b"}).collect()] == ["y"]
    rows = spark.createDataFrame([(1,), (2,), (9,)], "value int")
    both = dictionary.with_role(rows, "value", {"one": "A", "again": "a", "two": "b"}, "role")
    assert sorted((r.value, r.role or "") for r in both.collect()) == [(1, "again"), (1, "one"), (2, "two"), (9, "")]


def test_wide_pivot_names_are_those_of_the_picked_row(spark):
    rows = spark.createDataFrame(
        [(1, 7, 10, 100), (2, 7, 10, 101), (3, 8, 10, None)], "obs_id bigint, k bigint, concept_id int, value_coded int")
    names = spark.createDataFrame([(100, "old", "o"), (101, "new", "n")], "concept_id int, name string, short_name string")
    wanted = [obs_operators.Measure("shown", 10, "coded_name"), obs_operators.Measure("all", 10, "coded_list", separator=",")]
    found = {r.k: (r.shown, r["all"]) for r in obs_operators.pivot_obs(rows, "k", wanted, names=names).collect()}
    assert found == {7: ("new", "old,new"), 8: (None, None)}


def test_checkpoint_cuts_the_plan(spark):
    assert checkpoint(spark.range(3)).count() == 3


RANKED = ("latest_names", "latest_addresses", "latest_attribute", "latest_identifier")


def test_one_day_ranks_one_days_persons(spark, clinic, monkeypatch):
    """Names, addresses, phones, identifiers and providers are ranked for the report's rows (and its users) only."""
    seen = []
    for name in RANKED:
        make = getattr(lookups, name)
        monkeypatch.setattr(lookups, name, lambda rows, *a, make=make: seen.append(rows) or make(rows, *a))
    make = lookups.encounter_providers
    monkeypatch.setattr(lookups, "encounter_providers", lambda rows, *a: seen.append(rows) or make(rows, *a))
    day = str(clinic["encounter"].filter("voided = 0").agg(F.min("encounter_datetime")).first()[0])[:10]
    inside = clinic.encounters(None, day, day).select("encounter_id", "patient_id")
    people = inside.select("patient_id").union(clinic["users"].select("person_id")).distinct()
    for report in (
        vitals.vitals, diagnoses.diagnoses, visits.visits, visits.visit_diagnoses, visits.epidemiology, registration.front_sheet,
        history.history, note.clinical_note, prescriptions.controlled_encounters,
    ):
        report(clinic, day, day)
    assert len(seen) >= 14
    for rows in seen:
        key = next(c for c in ("encounter_id", "person_id", "patient_id") if c in rows.columns)
        known = inside.select(key) if key == "encounter_id" else people.withColumnRenamed("patient_id", key)
        assert rows.join(known, key, "left_anti").isEmpty()


def test_one_day_reads_one_days_visit_histories(spark, clinic, monkeypatch):
    seen = []
    make = visits.with_earlier_visit_flag
    monkeypatch.setattr(
        visits, "with_earlier_visit_flag", lambda due, past, flag: seen.append((due, past)) or make(due, past, flag)
    )
    day = str(clinic["encounter"].filter("voided = 0").agg(F.min("encounter_datetime")).first()[0])[:10]
    visits.visits(clinic, day, day)
    (due, past), = seen
    inside = clinic.encounters(None, day, day)
    assert due.join(inside, "visit_id", "left_anti").isEmpty()
    pairs = due.select("patient_id", F.year("date_started").alias("y")).distinct()
    assert past.withColumn("y", F.year("date_started")).join(pairs, ["patient_id", "y"], "left_anti").isEmpty()
