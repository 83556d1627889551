"""Data migrations as transforms; the caller writes the result."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from eavista import values
from eavista.operators.joins import superseded_encounters
from eavista.operators.latest import number_rows


def update_from(target: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Overwrite ``columns`` in the rows whose key occurs in ``changes`` (one row per key).

    A matched row takes the new value even when that is null, as an update does.
    """
    new = changes.select(
        F.col(key), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in columns]
    )
    joined = target.join(new, key, "left")
    kept = [
        F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else c
        for c in target.columns
    ]
    return joined.select(*kept)


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Insert ``rows``; columns they lack become null."""
    return target.unionByName(
        rows.select([c for c in rows.columns if c in target.columns]), allowMissingColumns=True
    )


def delete_matching(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return target.join(keys.select(key), key, "left_anti").select(target.columns)


def inconsistent_mappings(
    mapping: DataFrame, concept: DataFrame, rules: Sequence[tuple[str, Sequence[str]]]
) -> DataFrame:
    """(concept_map_id) of mappings whose (source, concept uuid) is in the rule lists."""
    bad = reduce(
        lambda a, b: a | b,
        [(F.col("source") == source) & F.col("uuid").isin(*uuids) for source, uuids in rules],
    )
    return (
        mapping.join(concept.select("concept_id", "uuid"), "concept_id")
        .filter(bad)
        .select("concept_map_id")
    )


#: What only a voided row has.
_VOID_FIELDS = ("date_voided", "void_reason", "voided_by")


def recode_obs(
    obs: DataFrame,
    old: int,
    new: int,
    now: Column,
    new_uuid: Column | None = None,
    include_voided: bool = False,
) -> DataFrame:
    """Void observations coded ``old`` and append amended copies coded ``new``.

    The whole table is returned. Voided rows are left alone, so a second run changes nothing;
    with ``include_voided`` they are copied too, and the caller must guard against a second run.
    The copies get ids above the highest id, in the order of the ids they replace, and point
    to them by ``previous_version``. By default their uuid is derived from the replaced one,
    so a recomputed task gives the same value.
    """
    due = due_for_recoding(old, include_voided)
    highest = obs.agg(F.max("obs_id")).scalar()
    return voided_for_recoding(obs, due, now).unionByName(recoded_copies(obs.filter(due), new, highest, new_uuid))


def due_for_recoding(old: int, include_voided: bool = False) -> Column:
    """Is a row coded ``old``, and live unless voided ones are due too?"""
    due = F.col("value_coded") == old
    if not include_voided:
        due = due & (F.col("voided") == 0)
    return F.coalesce(due, F.lit(False))


def voided_for_recoding(obs: DataFrame, due: Column, now: Column) -> DataFrame:
    """All rows, those that are due voided."""
    changes = {
        "voided": F.when(due, F.lit(1)).otherwise(F.col("voided")).cast("int"),
        "date_voided": F.when(due, now).otherwise(F.col("date_voided")),
        "void_reason": F.when(due, F.lit(values.RECODED_REASON)).otherwise(F.col("void_reason")),
    }
    return obs.select(*[changes.get(c, F.col(c)).alias(c) for c in obs.columns])


def recoded_copies(due: DataFrame, new: int, highest: Column, new_uuid: Column | None = None) -> DataFrame:
    """The amended copies of due rows, numbered on from ``highest`` in the order of their ids."""
    if new_uuid is None:
        digest = F.md5(F.concat(F.lit("amended "), F.col("uuid")))
        new_uuid = F.regexp_replace(digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    kinds = {f.name: f.dataType for f in due.schema}
    changes = {
        "obs_id": F.col("_new_id"),
        "value_coded": F.lit(new).cast(kinds["value_coded"]),
        "voided": F.lit(0),
        **{c: F.lit(None).cast(kinds[c]) for c in _VOID_FIELDS if c in kinds},
        "uuid": new_uuid,
        "previous_version": F.col("obs_id"),
        "status": F.lit(values.AMENDED),
    }
    numbered = number_rows(due, "_new_id", "obs_id", after=highest)
    return numbered.select(*[changes.get(c, F.col(c)).alias(c) for c in due.columns])


def void_superseded_encounters(
    encounters: DataFrame, obs: DataFrame, now: Column, voided_by: Column
) -> DataFrame:
    """Void live encounters that are wholly replaced by observations of other encounters."""
    due = superseded_encounters(encounters.filter("voided = 0"), obs).select(
        "encounter_id", F.lit(True).alias("_due")
    )
    joined = encounters.join(due, "encounter_id", "left")
    hit = F.coalesce(F.col("_due"), F.lit(False))
    changes = {
        "voided": F.when(hit, F.lit(1)).otherwise(F.col("voided")).cast("int"),
        "void_reason": F.when(hit, F.lit(values.DUPLICATE_REASON)).otherwise(F.col("void_reason")),
        "date_voided": F.when(hit, now).otherwise(F.col("date_voided")),
        "voided_by": F.when(hit, voided_by).otherwise(F.col("voided_by")),
    }
    return joined.select(*[changes.get(c, F.col(c)).alias(c) for c in encounters.columns])


def run_guarded(
    table: DataFrame, already_run: DataFrame, change: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``change(table)`` if ``already_run`` has no row, otherwise ``table`` unchanged.

    The test reads one row at most, and comes first: a change that is not due does no work.
    """
    return change(table) if already_run.isEmpty() else table
