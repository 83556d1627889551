"""Observations stored in buckets of a key, so that reports join and pivot them where they lie."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eavista.session import fresh_path

#: A bucket is read by one task: the largest may hold so many times the mean of all rows, or so many rows anyway.
UNEVEN, SMALL = 4, 1_000_000


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket that Spark's writer puts a row in."""
    return F.pmod(F.hash(F.col(key)), F.lit(buckets))


def largest_bucket(df: DataFrame, key: str, buckets: int) -> tuple[int, float]:
    """Rows of the largest bucket, and the mean of all."""
    sizes = df.groupBy(bucket_of(key, buckets)).agg(F.count("*").alias("n"))
    row = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return row["most"] or 0, (row["all"] or 0) / buckets


def store_bucketed(
    df: DataFrame,
    key: str = "encounter_id",
    buckets: int | None = None,
    order: Sequence[str] = ("concept_id", "obs_id"),
    name: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Write ``df`` as a table of one file a bucket, each sorted by ``order``, and read it back.

    A semi join or an aggregation on ``key`` then needs no exchange of these rows, and a filter on the
    first column of ``order`` leaves out the row groups that hold other values. One shuffle, when writing,
    replaces one for every report. ``buckets`` is the session's number of shuffle partitions unless given;
    with fewer buckets than that Spark prefers to shuffle both sides of a join.

    A key that holds very many rows makes a bucket that one task must read: such a table is refused
    (``ValueError``) before anything is written, and its plain form goes on to work. Rows without the key
    are all in one bucket and count for that; leave them out first where reports do not use them.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    most, mean = largest_bucket(df, key, buckets)
    if most > max(SMALL, UNEVEN * mean):
        raise ValueError(f"a bucket of {key} would hold {most} rows where the mean is {mean:.0f}")
    name = name or f"obs_by_{key}_{uuid.uuid4().hex}"
    # the exchange and the writer share the hash, so every task writes one bucket
    placed = df.repartition(buckets, key)
    writer = placed.write.format("parquet").bucketBy(buckets, key).sortBy(*order)
    writer.option("path", path or fresh_path(spark, name)).saveAsTable(name)
    return spark.table(name)
