"""Names for ids of which few distinct ones stand in very many rows, without moving the rows to the names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eavista.operators.joins import FEW_IDS, left_lookup

#: Most rows of a table whose names are sent to the tasks; larger tables are joined, hot ids dealt to parts.
INDEXED = 100_000
#: An index has its names in so many maps, as a map is searched entry by entry.
BUCKETS = 256


def is_small(table: DataFrame) -> bool:
    """Whether the table has at most ``INDEXED`` rows; no more than that are read."""
    return table.limit(INDEXED + 1).count() <= INDEXED


def name_index(rows: DataFrame, column: str, table: DataFrame, key: str, shown: str) -> Column:
    """Names of the distinct ids in ``column``, as one value: bucket → id → name.

    Every task that scans ``rows`` sends each id once. ``table`` has at most one row per id, and at most
    ``INDEXED`` rows: that bounds the value, which is a scalar subquery.
    """
    used = rows.select(F.col(column).cast("bigint").alias("_id")).filter("_id IS NOT NULL").distinct()
    named = table.select(F.col(key).cast("bigint").alias("_id"), F.col(shown).alias("_name"))
    entries = F.map_from_entries(F.collect_list(F.struct("_id", "_name")))
    buckets = (
        named.filter("_id IS NOT NULL AND _name IS NOT NULL")
        .join(used, "_id", "left_semi")
        .groupBy(F.pmod("_id", F.lit(BUCKETS)).alias("_bucket"))
        .agg(entries.alias("_names"))
    )
    return buckets.agg(F.map_from_entries(F.collect_list(F.struct("_bucket", "_names")))).scalar()


def named(index: Column, value: Column) -> Column:
    """The name of one id in an index; null for an id without a name."""
    found = F.try_element_at(index, F.pmod(value.cast("bigint"), F.lit(BUCKETS)))
    return F.try_element_at(found, value.cast("bigint"))


def used_names(rows: DataFrame, column: str, table: DataFrame, key: str) -> DataFrame:
    """The table's rows of the ids in ``column``, to be sent to the tasks; the whole table where these are more than ``INDEXED``.

    ``table`` has at most one row per id. The ids are counted when this is called.
    """
    used = rows.select(F.col(column).cast("bigint").alias("_id")).filter("_id IS NOT NULL").distinct()
    if not is_small(used):
        return table
    return F.broadcast(table.join(F.broadcast(used), F.col(key).cast("bigint") == F.col("_id"), "left_semi"))


def with_name(
    rows: DataFrame, column: str, table: DataFrame, key: str, shown: str, name: str, spread: str, small: bool | None = None
) -> DataFrame:
    """Add ``shown`` of the table's row whose ``key`` is the row's ``column``, as ``name``.

    The rows stay where they are while the table is small; ``small`` says so where it is known already. Of a large table
    the names in use are sent to the rows where they are few; else both are joined, hot ids dealt to parts.
    """
    if is_small(table) if small is None else small:
        return rows.withColumn(name, named(name_index(rows, column, table, key, shown), F.col(column)))
    found = used_names(rows, column, table, key)
    salts = FEW_IDS if found is table else 1
    found = found.select(F.col(key).alias("_named"), F.col(shown).alias(name))
    return left_lookup(rows, found, column, "_named", spread, salts)
