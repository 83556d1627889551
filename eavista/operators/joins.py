"""Joins with the shapes that clinical tables need."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F


#: Copies of a small table whose few ids each stand in very many rows.
FEW_IDS = 16
#: A value group with more than one part in so many of all records is dealt to so many tasks.
LARGE_PART, DEALT = 256, 64
#: Groups of a table with fewer records than this are small for any task.
SMALL_TABLE = 1_000_000


def left_lookup(
    df: DataFrame, table: DataFrame, key: str, table_key: str, spread: str | Column, salts: int = 1
) -> DataFrame:
    """Left join on an optional id, ``table`` having at most one row per id.

    Rows without an id cannot match. They get a key of their own below zero (ids are never
    negative), made from ``spread``, so they do not all meet in one shuffle partition. With
    ``salts`` the rows of one present id are dealt to so many parts, each with its copy of the
    table: for small tables, such as places and users, of which few ids are used.
    """
    spread = F.col(spread) if isinstance(spread, str) else spread
    lonely = -F.abs(spread.cast("bigint")) - 1
    right = table.withColumnRenamed(table_key, "_lookup_key")
    on = F.coalesce(F.col(key).cast("bigint"), lonely) == F.col("_lookup_key")
    if salts > 1:
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = on & (F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int") == F.col("_salt"))
        return df.join(right, on, "left").drop("_lookup_key", "_salt")
    return df.join(right, on, "left").drop("_lookup_key")


def related_obs(obs: DataFrame, seeds: DataFrame) -> DataFrame:
    """Observations that share a group with a seed observation, or are one of the seeds.

    ``seeds`` are observations of the same table. A seed with a group is already found by its
    group, so only seeds without a group need the second branch: the two equi joins cannot
    return the same row and no deduplication is needed.
    """
    groups = seeds.select("obs_group_id").filter("obs_group_id IS NOT NULL").distinct()
    alone = seeds.filter("obs_group_id IS NULL").select("obs_id").distinct()
    in_groups = obs.join(groups, "obs_group_id", "left_semi")
    by_id = obs.filter("obs_group_id IS NULL").join(alone, "obs_id", "left_semi")
    return in_groups.select(obs.columns).unionByName(by_id.select(obs.columns))


def with_first_time_flag(
    df: DataFrame, history: DataFrame, keys: list[str], time: str, flag: str
) -> DataFrame:
    """``flag`` is true when ``history`` has no earlier row with the same keys.

    The earliest time per key is a small aggregate, joined back, instead of a join of every
    row with all its predecessors.
    """
    earliest = (
        history.dropna(subset=keys).groupBy(*keys).agg(F.min(time).alias("_earliest"))
    )
    earlier = F.coalesce(F.col("_earliest") < F.col(time), F.lit(False))
    return df.join(earliest, keys, "left").withColumn(flag, ~earlier).drop("_earliest")


def with_earlier_visit_flag(visits: DataFrame, history: DataFrame, flag: str) -> DataFrame:
    """True when the patient had a visit that ended before this one began, in the same year."""
    first_end = (
        history.filter("date_stopped IS NOT NULL")
        .groupBy("patient_id", F.year("date_started").alias("_year"))
        .agg(F.min("date_stopped").alias("_first_end"))
    )
    seen = F.coalesce(F.col("_first_end") < F.col("date_started"), F.lit(False))
    return (
        visits.withColumn("_year", F.year("date_started"))
        .join(first_end, ["patient_id", "_year"], "left")
        .withColumn(flag, seen)
        .drop("_year", "_first_end")
    )


def _successors(obs: DataFrame) -> DataFrame:
    """Per replaced observation: the smallest and largest encounter that replaces it."""
    return (
        obs.filter("previous_version IS NOT NULL")
        .groupBy(F.col("previous_version").alias("obs_id"))
        .agg(F.min("encounter_id").alias("_low"), F.max("encounter_id").alias("_high"))
    )


def encounters_replaced_elsewhere(obs: DataFrame) -> DataFrame:
    """Encounters with an observation that an observation of another encounter replaces."""
    elsewhere = (F.col("_low") != F.col("encounter_id")) | (F.col("_high") != F.col("encounter_id"))
    return (
        obs.select("obs_id", "encounter_id")
        .join(_successors(obs), "obs_id")
        .filter(elsewhere)
        .select("encounter_id")
        .distinct()
    )


def encounters_fully_replaced(encounters: DataFrame, obs: DataFrame) -> DataFrame:
    """Encounters none of whose observations is still unreplaced (also those without any)."""
    standing = (
        obs.select("obs_id", "encounter_id")
        .join(_successors(obs).select("obs_id"), "obs_id", "left_anti")
        .select("encounter_id")
        .distinct()
    )
    return encounters.join(standing, "encounter_id", "left_anti")


def superseded_encounters(encounters: DataFrame, obs: DataFrame) -> DataFrame:
    """Encounters that are fully replaced and replaced at least once from elsewhere.

    Both conditions come from one pass: each observation meets its at most one successor row,
    then one aggregate per encounter.
    """
    state = (
        obs.select("obs_id", "encounter_id")
        .join(_successors(obs), "obs_id", "left")
        .groupBy("encounter_id")
        .agg(
            F.bool_and(F.col("_low").isNotNull()).alias("_all"),
            F.bool_or(
                F.coalesce(
                    (F.col("_low") != F.col("encounter_id"))
                    | (F.col("_high") != F.col("encounter_id")),
                    F.lit(False),
                )
            ).alias("_elsewhere"),
        )
        .filter("_all AND _elsewhere")
    )
    return encounters.join(state, "encounter_id", "left_semi")


def _large_groups(keyed: DataFrame, records: Column) -> DataFrame:
    """(_mask, _key, _large): fewer than ``LARGE_PART`` groups a mask, so the table is broadcast."""
    # counts are combined before the shuffle
    sizes = keyed.groupBy("_mask", "_key").agg(F.count("*").alias("_size"))
    large = sizes.filter(F.col("_size") * LARGE_PART > F.greatest(records, F.lit(SMALL_TABLE)))
    return F.broadcast(large.select("_mask", "_key", F.lit(True).alias("_large")))


def _dealt(keyed: DataFrame, large: DataFrame) -> DataFrame:
    """Add ``_part``: 0, or for a large group a part by a hash of the id."""
    part = F.when(F.col("_large"), F.pmod(F.xxhash64("_id"), F.lit(DEALT)).cast("int")).otherwise(0)
    return keyed.join(large, ["_mask", "_key"], "left").withColumn("_part", part).drop("_large")


def similar_records(
    records: DataFrame, id_column: str, weights: Mapping[str, int], top: int
) -> DataFrame:
    """For each record the ``top`` other records with the highest weight of equal fields.

    Ties go to the smaller id. Columns: id, similar_id, score, rank.

    Records are never paired with everyone in their block. For each set of fields, the
    ``top + 1`` smallest ids of every value group are enough: if a true partner is not among
    those of the group of exactly its equal fields, then at least ``top`` others there score
    no less and have a smaller id. So a record meets at most ``top + 1`` candidates per field
    set, however large its groups are, and the result is exact.

    The records of a large group are dealt to ``DEALT`` parts by a hash of their id, each with a copy of the
    group's few candidates. Groups with more than 1 / ``LARGE_PART`` of the records are fewer than
    ``LARGE_PART`` a field set: that bounds the table of large groups, which is broadcast.
    """
    fields = list(weights)
    own = records.select(F.col(id_column).cast("bigint").alias("_id"), *fields)
    own = own.filter(reduce(lambda a, b: a | b, [F.col(f).isNotNull() for f in fields]))

    # one row per record and per non-empty set of present fields, keyed by the values of the set
    field_sets = [s for n in range(1, len(fields) + 1) for s in combinations(range(len(fields)), n)]
    entries = []
    for chosen in field_sets:
        mask = sum(1 << i for i in chosen)
        present = reduce(lambda a, b: a & b, [F.col(fields[i]).isNotNull() for i in chosen])
        key = [
            F.col(f).cast("string") if i in chosen else F.lit(None).cast("string")
            for i, f in enumerate(fields)
        ]
        entries.append(
            F.when(
                present,
                F.struct(F.lit(mask).alias("_mask"), F.to_json(F.array(*key)).alias("_key")),
            )
        )
    keyed = own.select("_id", *fields, F.inline(F.array_compact(F.array(*entries))))

    smallest = Window.partitionBy("_mask", "_key").orderBy("_id")
    heads = (
        keyed.withColumn("_n", F.row_number().over(smallest))
        .filter(F.col("_n") <= top + 1)
        .select("_mask", "_key", F.col("_id").alias("similar_id"),
                *[F.col(f).alias(f"_{f}") for f in fields])
    )
    large = _large_groups(keyed, own.agg(F.count("*")).scalar())
    keyed = _dealt(keyed, large)
    copies = F.when(F.col("_large"), F.sequence(F.lit(0), F.lit(DEALT - 1))).otherwise(F.array(F.lit(0)))
    heads = heads.join(large, ["_mask", "_key"], "left").withColumn("_part", F.explode(copies)).drop("_large")

    equal = {f: F.coalesce(F.col(f) == F.col(f"_{f}"), F.lit(False)) for f in fields}
    same_mask = sum((F.when(equal[f], 1 << i).otherwise(0) for i, f in enumerate(fields)), F.lit(0))
    score = sum((F.when(equal[f], w).otherwise(0) for f, w in weights.items()), F.lit(0))
    candidates = (
        keyed.join(heads, ["_mask", "_key", "_part"])
        .filter((F.col("_id") != F.col("similar_id")) & (same_mask == F.col("_mask")))
        .select("_id", "similar_id", score.cast("int").alias("score"))
    )
    best = Window.partitionBy("_id").orderBy(F.col("score").desc(), F.col("similar_id"))
    return (
        candidates.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
        .select(F.col("_id").alias(id_column), "similar_id", "score", "rank")
    )
