"""Names of coded answers: observations are not moved to the dictionary, and both ways give the same names."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from eavista.operators import naming
from eavista.operators.lookups import Dictionary
from eavista.operators.obs import Measure, pivot_obs
from tests.compare import SF_DIR
from tests.test_scale import _children, no_broadcast  # noqa: F401


def _nodes(node):
    yield node
    for child in _children(node):
        yield from _nodes(child)


@pytest.mark.parametrize("key", [
    "obs_value_coded_list", "obs_group_value_coded_list", "obs_rapid_test_labels", "agg_ordered_string_list", "union_all_coded_and_text",
])
def test_no_exchange_on_the_answer(spark, no_broadcast, key):  # noqa: F811
    plan = entry.queries()[key](spark, SF_DIR)._jdf.queryExecution().executedPlan()
    moved = [n.toString().split("\n")[0] for n in _nodes(plan) if n.nodeName() == "Exchange"]
    assert not [m for m in moved if "value_coded" in m]
    assert not any("_lookup_key" in m for m in moved)


def _coded(spark):
    rows = [(n, n % 5, 10 + n % 2, None if n % 7 == 0 else 1000 + n % 6) for n in range(60)]
    obs = spark.createDataFrame(rows, "obs_id bigint, k bigint, concept_id int, value_coded int")
    # 1003 has no row, 1004 an empty and 1005 a null name
    names = [(1000, "a"), (1001, "b"), (1002, "c"), (1004, ""), (1005, None), (7, "unused")]
    return rows, obs, spark.createDataFrame(names, "concept_id int, name string"), dict(names)


@pytest.mark.parametrize("indexed", [naming.INDEXED, 0])
def test_lists_name_every_known_answer_in_order(spark, monkeypatch, indexed):
    monkeypatch.setattr(naming, "INDEXED", indexed)
    rows, obs, names, known = _coded(spark)
    wanted = [Measure("odd", 11, "coded_list", separator=","), Measure("b", 10, "coded_list", 1002, separator=",")]
    found = {r.k: (r.odd, r.b) for r in pivot_obs(obs, "k", wanted, names=names).collect()}

    def texts(k, concept, answer=None):
        shown = [known.get(v) for _, key, c, v in rows if key == k and c == concept and answer in (None, v)]
        shown = [s for s in shown if s is not None]
        return ",".join(shown) if shown else None

    assert found == {k: (texts(k, 11), texts(k, 10, 1002)) for k in range(5)}


@pytest.mark.parametrize("indexed", [naming.INDEXED, 0])
def test_names_of_rows(spark, monkeypatch, indexed):
    monkeypatch.setattr(naming, "INDEXED", indexed)
    rows, obs, names, known = _coded(spark)
    found = naming.with_name(obs, "value_coded", names, "concept_id", "name", "shown", "obs_id")
    assert found.columns == [*obs.columns, "shown"]
    assert {r.obs_id: r.shown for r in found.collect()} == {n: known.get(v) for n, _, _, v in rows}
    none = naming.with_name(obs.filter("false"), "value_coded", names.filter("false"), "concept_id", "name", "shown", "obs_id")
    assert none.isEmpty()


def test_size_is_counted_once_and_bounds_the_index(spark, monkeypatch):
    names = spark.createDataFrame([(n, f"n{n}", "es", 1, n, None, 0) for n in range(20)],
        "concept_id int, name string, locale string, locale_preferred int, concept_name_id int, concept_name_type string, voided int")
    calls = []
    is_small = naming.is_small
    monkeypatch.setattr(naming, "is_small", lambda table: calls.append(1) or is_small(table))
    monkeypatch.setattr(naming, "INDEXED", 19)
    dictionary = Dictionary(None, names)
    assert dictionary.is_small() is False and dictionary.is_small() is False and len(calls) == 1
    rows = spark.range(40).select(F.col("id").alias("obs_id"), F.col("id").alias("value_coded"))
    found = dictionary.with_name(rows, "value_coded", "name", "obs_id")
    assert found.filter("name = concat('n', obs_id)").count() == 20 and found.filter("name IS NULL").count() == 20
