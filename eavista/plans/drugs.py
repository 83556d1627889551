"""Drug quantity reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eavista import values
from eavista.operators.filters import Day, active, in_date_range
from eavista.operators.joins import left_lookup
from eavista.operators.obs import group_totals
from eavista.sources.clinic import Clinic


def _live(df: DataFrame, include_voided: bool) -> DataFrame:
    return df if include_voided else active(df)


def meds_stock(
    clinic: Clinic,
    start: Day,
    end: Day,
    name_prefix: str,
    include_voided: bool = False,
    all_numeric: bool = False,
) -> DataFrame:
    """Quantity per drug and clinic for the drugs whose name starts with ``name_prefix``.

    A drug that was not used has one row without quantity and clinic. ``all_numeric`` sums
    every numeric value of the drug's groups instead of the dispensed quantity only.
    """
    dictionary = clinic.dictionary
    drugs = clinic.active("drug").filter(F.col("name").startswith(name_prefix))
    drugs = drugs.select("drug_id", F.col("name").alias("Medicamento"))
    obs = _live(clinic["obs"], include_voided)

    uses = in_date_range(obs.filter("value_drug IS NOT NULL"), "obs_datetime", start, end)
    uses = uses.select("obs_id", "obs_group_id", "location_id", F.col("value_drug").alias("drug_id"))
    uses = uses.join(drugs.select("drug_id"), "drug_id", "left_semi")
    quantities = obs.select("obs_group_id", "concept_id", "value_numeric")
    if not all_numeric:
        quantities = dictionary.only_role(
            quantities, "concept_id", {"quantity": values.DISPENSED_QUANTITY}, "_role"
        )
    groups = uses.select("obs_group_id").filter("obs_group_id IS NOT NULL").distinct()
    totals = group_totals(quantities.join(groups, "obs_group_id", "left_semi"), "_total")
    used = (
        left_lookup(uses, totals.withColumnRenamed("obs_group_id", "_group"), "obs_group_id",
                    "_group", "obs_id")
        .groupBy("drug_id", "location_id")
        .agg(F.sum("_total").cast("double").alias("Cantidad"))
    )
    rows = drugs.join(used, "drug_id", "left")
    return clinic.with_location(rows, "location_id", "Clinica", "drug_id").select(
        "Medicamento", "Cantidad", "Clinica"
    )


def meds_dispensed(
    clinic: Clinic, start: Day, end: Day, name_prefix: str = "SSA: ", include_voided: bool = False
) -> DataFrame:
    """Dispensed quantity per drug of one prefix; the clinic is the first by name."""
    dictionary = clinic.dictionary
    drugs = clinic["drug"].filter(F.col("name").startswith(name_prefix))
    drugs = drugs.select("drug_id", F.col("name").alias("Medicamento"))
    obs = _live(clinic["obs"], include_voided)

    quantities = dictionary.only_role(
        in_date_range(obs, "obs_datetime", start, end),
        "concept_id",
        {"quantity": values.DISPENSED_QUANTITY},
        "_role",
    )
    # a drug of a group with a quantity observation counts even when no number was entered
    totals = (
        quantities.filter("obs_group_id IS NOT NULL")
        .groupBy("obs_group_id")
        .agg(F.sum(F.col("value_numeric").cast("decimal(38,6)")).alias("_total"))
    )
    given = dictionary.only_role(
        obs.filter("value_drug IS NOT NULL AND obs_group_id IS NOT NULL"),
        "concept_id",
        {"medication": values.MEDICATION},
        "_role",
    ).select("obs_id", "obs_group_id", "location_id", F.col("value_drug").alias("drug_id"))
    rows = given.join(totals, "obs_group_id")
    rows = clinic.with_location(rows, "location_id", "_clinic", "obs_id")
    sums = rows.groupBy("drug_id").agg(
        F.sum("_total").cast("double").alias("Cantidad"), F.min("_clinic").alias("Clinica")
    )
    return drugs.join(sums, "drug_id").select("Medicamento", "Cantidad", "Clinica")
