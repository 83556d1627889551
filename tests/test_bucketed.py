"""Bucketed observations: no exchange above the scan, the same rows, uneven keys refused."""

import pytest
from pyspark.sql import functions as F

from eavista import values
from eavista.catalog.fixture import Fixture
from eavista.operators.obs import measures, narrow_obs, pivot_obs
from eavista.session import fresh_path
from eavista.sources import bucketed
from tests.compare import SF_DIR
from tests.test_scale import _path_to


@pytest.fixture(scope="module")
def fx(spark):
    return Fixture.of(spark, SF_DIR)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _vitals(fx, obs):
    codes = [code for _, code, _ in values.VITALS_MEASURES]
    year = fx.clinic.encounters(None, "1996-01-01", "1996-12-31")
    rows = narrow_obs(obs, year, codes=codes, dictionary=fx.clinic.dictionary)
    return pivot_obs(rows, "encounter_id", measures(values.VITALS_MEASURES), fx.clinic.dictionary)


def test_no_exchange_above_the_bucketed_scan(fx, no_broadcast):
    stored = fx.bucketed_obs()
    plan = _vitals(fx, stored)._jdf.queryExecution().executedPlan()
    path = _path_to(plan, lambda n: "fx_bucketed_obs" in n.toString())
    names = [n.nodeName() for n in path]
    assert path and "SortMergeJoin" in names and sum(n.endswith("Aggregate") for n in names) >= 1
    assert not [n for n in names if "Exchange" in n]
    scan = path[0].verboseStringWithOperatorId()
    assert "Bucketed: true" in scan and "In(concept_id" in scan


def test_same_rows_as_from_the_plain_table(fx):
    plain, stored = _vitals(fx, fx.clinic["obs"]), _vitals(fx, fx.bucketed_obs())
    assert plain.count() > 0
    assert plain.exceptAll(stored).isEmpty() and stored.exceptAll(plain).isEmpty()


def test_one_sorted_file_a_bucket(spark):
    rows = spark.range(20_000).select(
        F.col("id").alias("obs_id"), (F.col("id") % 700).alias("encounter_id"), (F.col("id") % 13).alias("concept_id"))
    path = fresh_path(spark, "buckets-test")
    stored = bucketed.store_bucketed(rows, buckets=8, path=path)
    files = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"))
    assert files.select("file").distinct().count() == 8 and stored.count() == 20_000
    place = files.withColumn("n", F.monotonically_increasing_id())
    ahead = F.lag("concept_id").over(bucketed_window())
    assert place.withColumn("ahead", ahead).filter("ahead > concept_id").isEmpty()


def bucketed_window():
    from pyspark.sql import Window

    return Window.partitionBy("file").orderBy("n")


def test_uneven_keys_are_refused_before_writing(spark, monkeypatch):
    monkeypatch.setattr(bucketed, "SMALL", 1_000)
    rows = spark.range(10_000).select(F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id")).alias("encounter_id"))
    with pytest.raises(ValueError, match="a bucket of encounter_id"):
        bucketed.store_bucketed(rows, buckets=8, order=("encounter_id",), name="never_written")
    assert not spark.catalog.tableExists("never_written")


def test_empty_table_and_null_keys(spark):
    rows = spark.createDataFrame([], "encounter_id bigint, concept_id int, obs_id bigint")
    assert bucketed.store_bucketed(rows, buckets=8).count() == 0
    rows = spark.createDataFrame([(None, 1, 1), (5, None, 2)], rows.schema)
    assert sorted(r.obs_id for r in bucketed.store_bucketed(rows, buckets=8).collect()) == [1, 2]
