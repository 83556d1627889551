"""A report: parameters, named datasets and output designs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from eavista.operators.filters import Day
from eavista.sources.clinic import Clinic


@dataclass(frozen=True)
class Report:
    """``datasets`` maps a name to a function of (clinic, start=, end=[, patient_id=])."""

    key: str
    datasets: dict[str, Callable[..., DataFrame]]
    by_patient: bool = False
    designs: Sequence[tuple[str, str | None]] = field(default_factory=tuple)

    def run(
        self,
        clinic: Clinic,
        start: Day = None,
        end: Day = None,
        patient_id: int | None = None,
        **options,
    ) -> dict[str, DataFrame]:
        """The datasets by name; ``options`` are passed on to their functions."""
        if patient_id is not None and not self.by_patient:
            raise ValueError(f"{self.key} runs for a date range only")
        if patient_id is None and (start is None or end is None):
            raise ValueError(f"{self.key} needs a start and an end date")
        extra = {"patient_id": patient_id} if self.by_patient else {}
        return {
            name: build(clinic, start=start, end=end, **extra, **options)
            for name, build in self.datasets.items()
        }


def design_variants(dataset: DataFrame, designs: Sequence[tuple[str, str | None]]) -> DataFrame:
    """Every row once per design, with the design's constants as columns."""
    variants = F.array(
        *[
            F.struct(
                F.lit(name).alias("design"), F.lit(district).cast("string").alias("district_name")
            )
            for name, district in designs
        ]
    )
    return dataset.select("*", F.inline(variants))


def nested(parent: DataFrame, child: DataFrame, key: str, name: str, *order: str) -> DataFrame:
    """Parent rows with their child rows as one ordered array of structs.

    The array is the document part of one encounter; parents without children get an empty one.
    """
    fields = [c for c in order] + [c for c in child.columns if c != key and c not in order]
    lists = child.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))
    empty = F.array().cast(lists.schema[name].dataType)
    return parent.join(lists, key, "left").withColumn(name, F.coalesce(F.col(name), empty))
