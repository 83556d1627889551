"""Changes of stored tables: only files with due rows are written, failures leave or finish a whole state."""

import os

import pytest
from pyspark.sql import functions as F

from eavista.operators import migrate, stored
from eavista.sources import sites, swap

OBS = (
    "obs_id bigint, encounter_id bigint, value_coded int, voided int, uuid string, date_voided string, void_reason string, "
    "voided_by bigint, previous_version bigint, status string"
)


def data_files(path):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def table(spark, tmp_path):
    """Twenty files of a hundred rows; those of ids 300 to 399 and 1700 to 1799 hold due rows."""
    path = str(tmp_path / "obs")
    ids = spark.range(0, 2000, 1, 20)
    ids.select(
        F.col("id").alias("obs_id"), (F.col("id") % 50).alias("encounter_id"),
        F.when(F.col("id").isin(310, 355, 1701), 203).otherwise(F.col("id") % 7).cast("int").alias("value_coded"),
        F.when(F.col("id") == 355, 1).otherwise(0).alias("voided"), F.concat(F.lit("u-"), "id").alias("uuid"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in
          (("date_voided", "string"), ("void_reason", "string"), ("voided_by", "bigint"), ("previous_version", "bigint"))],
        F.lit("FINAL").alias("status"),
    ).write.parquet(path)
    assert len(data_files(path)) == 20
    return path


def test_recoding_touches_two_files_of_twenty(spark, table):
    before = data_files(table)
    wanted = rows_of(migrate.recode_obs(spark.read.parquet(table), 203, 202, F.lit("now")))
    change = stored.recode_obs(spark, table, 203, 202, F.lit("now"))
    assert len(change.touched) == 2 and len(change.untouched) == 18
    assert rows_of(change.result()) == wanted and data_files(table) == before
    change.commit()
    after = data_files(table)
    assert len(before.items() & after.items()) == 18
    assert rows_of(spark.read.parquet(table)) == wanted
    again = stored.recode_obs(spark, table, 203, 202, F.lit("now"))
    assert again.touched == [] and rows_of(again.result()) == wanted
    again.commit()
    assert data_files(table) == after


def test_update_and_delete_by_file(spark, table):
    before = data_files(table)
    changes = spark.createDataFrame([(310, "changed"), (5000, "nowhere")], "obs_id bigint, status string")
    wanted = rows_of(migrate.update_from(spark.read.parquet(table), changes, "obs_id", ["status"]))
    update = stored.update_from(spark, table, changes, "obs_id", ["status"])
    assert rows_of(update.result()) == wanted
    update.commit()
    assert rows_of(spark.read.parquet(table)) == wanted and len(before.items() & data_files(table).items()) == 19
    middle = data_files(table)
    keys = spark.createDataFrame([(5,), (1701,), (9999,)], "obs_id bigint")
    wanted = rows_of(migrate.delete_matching(spark.read.parquet(table), keys, "obs_id"))
    stored.delete_matching(spark, table, keys, "obs_id").commit()
    assert rows_of(spark.read.parquet(table)) == wanted and len(middle.items() & data_files(table).items()) == 18


def test_partitioned_table_keeps_its_folders(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.range(40).select("id", (F.col("id") % 4).alias("site"), F.lit("old").alias("note")).write.partitionBy("site").parquet(path)
    changes = spark.createDataFrame([(6, "new")], "id bigint, note string")
    stored.update_from(spark, path, changes, "id", ["note"], partitions=("site",)).commit()
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 40 and [(r.id, r.site) for r in rows if r.note == "new"] == [(6, 2)]


def test_failed_change_leaves_the_table(spark, table):
    before = data_files(table)
    broken = spark.createDataFrame([(310, "x")], "obs_id bigint, status string").withColumn(
        "status", F.raise_error(F.lit("broken")).cast("string")
    )
    with pytest.raises(Exception, match="broken"):
        stored.update_from(spark, table, broken, "obs_id", ["status"]).commit()
    assert before.items() <= data_files(table).items() and spark.read.parquet(table).count() == 2000
    swap.recover(spark, table)
    assert data_files(table) == before


@pytest.fixture
def sites_table(spark, tmp_path):
    path = str(tmp_path / "sites")
    sites.overwrite_partitions(spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "n int, partition_num int"), path)
    return path


def content(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).collect())


def test_input_is_evaluated_once(spark, sites_table):
    seen = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(10, 1), (30, 3)], "n int, partition_num int")

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    sites.overwrite_partitions(rows.mapInPandas(counted, rows.schema), sites_table, loaded=(1, 2, 3))
    assert seen.value == 2 and content(spark, sites_table) == [(10, 1), (30, 3)]


def test_failed_load_leaves_old_partitions(spark, sites_table):
    broken = spark.createDataFrame([(9, 1), (9, 3)], "n int, partition_num int").withColumn(
        "n", F.when(F.col("partition_num") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("n")).cast("int")
    )
    with pytest.raises(Exception, match="broken"):
        sites.overwrite_partitions(broken, sites_table, loaded=(1, 2, 3))
    assert content(spark, sites_table) == [(1, 1), (2, 2), (3, 3)]


@pytest.mark.parametrize("done", range(4))
def test_interrupted_swap_is_finished(spark, sites_table, monkeypatch, done):
    """The swap stops after so many renames and deletions; the next run ends it first."""
    left = [done]
    move, remove = swap.Files.move, swap.Files.remove

    def counted(call):
        def run(self, *paths):
            if "partition_num=" in paths[0]:
                left[0] -= 1
                if left[0] < 0:
                    raise OSError("stopped")
            return call(self, *paths)
        return run

    monkeypatch.setattr(swap.Files, "move", counted(move))
    monkeypatch.setattr(swap.Files, "remove", counted(remove))
    rows = spark.createDataFrame([(10, 1), (30, 3)], "n int, partition_num int")
    with pytest.raises(OSError, match="stopped"):
        sites.overwrite_partitions(rows, sites_table, loaded=(1, 2, 3))
    monkeypatch.undo()
    swap.recover(spark, sites_table)
    assert content(spark, sites_table) == [(10, 1), (30, 3)]
    assert not [n for n in os.listdir(sites_table) if n.startswith(("_staged", "_swap"))]
