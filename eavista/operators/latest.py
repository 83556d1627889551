"""One row per key, and numbering over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: str | Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` lets Spark keep one row per key in every map task before the
    shuffle, so a key that holds much of the table is cheap too. Rows without a key are dropped.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    )


def newest(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


#: Bounds of parts are picked from about so many sampled rows a part.
SAMPLED = 32


def _bounds(df: DataFrame, order: Sequence[str], parts: int) -> Column:
    """At most ``parts - 1`` keys, ascending, that cut the rows into parts of about equal size.

    The sample is the rows with a small hash of their order columns, so it is the same in every
    run, and has about ``SAMPLED * parts`` rows of any table. Both steps are scalar subqueries.
    """
    total = df.agg(F.greatest(F.count("*"), F.lit(1)).cast("double")).scalar()
    place = F.xxhash64(*order) / F.lit(2.0**64) + F.lit(0.5)
    sampled = df.select(*order).filter(place * total < F.lit(float(SAMPLED * parts)))
    keys = sampled.agg(F.array_sort(F.collect_set(F.struct(*order))).alias("keys")).filter(F.size("keys") > 0)
    picked = F.transform(
        F.sequence(F.lit(1), F.lit(parts - 1)),
        lambda i: F.element_at("keys", (F.size("keys") * i / parts).cast("int") + 1),
    )
    return keys.select(F.array_distinct(picked)).scalar()


def with_part(df: DataFrame, order: Sequence[str], parts: int) -> DataFrame:
    """``df`` with ``_part``: how many bounds are below the row's key, by bisection."""
    key = F.struct(*order)
    placed = df.withColumn("_bounds", _bounds(df, order, parts)).withColumn("_part", F.lit(0))
    step = 1 << parts.bit_length() - 1
    while step:
        # plain columns, not a function of higher order, so that all steps are in generated code; null behind the last bound
        below = F.get("_bounds", F.col("_part") + F.lit(step - 1)) < key
        placed = placed.withColumn("_part", F.col("_part") + F.when(below, step).otherwise(0))
        step >>= 1
    return placed.drop("_bounds")


def number_rows(df: DataFrame, name: str, *order: str, after: Column | int = 0) -> DataFrame:
    """Number all rows 1, 2, 3 … (plus ``after``) in a total order given by unique columns.

    Bounds from a sample by hash cut the order into balanced parts, also where the first order
    column has few values; the parts are counted, and each is numbered on its own from the row
    counts of the parts before it. No task sees more than one part and nothing is written: the
    bounds depend on the rows alone, so a lost task repeats its numbers. ``df`` is read for the
    count, the bounds, the parts and the numbers, all but the last with the order columns only, so
    it must give the same rows each time (write it first where it does not). Nulls come first.
    """
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = with_part(df, order, parts)
    # at most `parts` rows
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    start = F.lit(after) if isinstance(after, int) else after
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, (inside + F.col("_before") + start).cast("bigint"))
        .drop("_part", "_before")
    )


def carry_forward(
    df: DataFrame, key: str, time: str, tie: str, value: str, name: str, bucket: str = "day"
) -> DataFrame:
    """``name`` is ``value``, or the last non-null one of the key before it in (time, tie) order.

    The order of a key is cut into calendar buckets: a window inside each bucket, and one
    carried value per bucket from the buckets before it. So a key with very many rows is
    worked on by many tasks, and the window over buckets sees one row per key and bucket.
    """
    filled = F.col(value).isNotNull()
    rows = df.withColumn("_bucket", F.date_trunc(bucket, time))
    buckets = rows.groupBy(key, "_bucket").agg(
        F.max_by(value, F.when(filled, F.struct(time, tie))).alias("_last")
    )
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.select(
        key, "_bucket", F.last("_last", ignorenulls=True).over(before).alias("_carried")
    )
    inside = (
        Window.partitionBy(key, "_bucket")
        .orderBy(time, tie)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("_inside", F.last(value, ignorenulls=True).over(inside))
        .join(carried, [key, "_bucket"], "left")
        .withColumn(name, F.coalesce("_inside", "_carried"))
        .drop("_bucket", "_inside", "_carried")
    )
