"""The clinical tables of one site or warehouse."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eavista import values
from eavista.operators import lookups
from eavista.operators.filters import Day, active, patient_or_range
from eavista.operators.joins import FEW_IDS, left_lookup
from eavista.operators.lookups import Dictionary


@dataclass(frozen=True)
class Clinic:
    """Named tables plus the deployment's dictionary settings.

    ``local_source`` names the mapping source of codes that carry no source prefix.
    """

    tables: Mapping[str, DataFrame]
    local_source: str = "LOCAL"
    locale: str = values.DEFAULT_LOCALE
    test_patient_attribute: int = 1
    phone_attribute: int = 2

    @classmethod
    def from_parquet(cls, spark: SparkSession, path: str, names: list[str], **settings) -> Clinic:
        """Tables stored as ``<path>/<name>.parquet`` or as folders of that name."""
        return cls({n: spark.read.parquet(f"{path}/{n}.parquet") for n in names}, **settings)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def active(self, name: str) -> DataFrame:
        """A table without its voided or retired rows."""
        return active(self.tables[name])

    @cached_property
    def dictionary(self) -> Dictionary:
        """Codes and names; the mapping may be one table or the raw map, term and source."""
        if "concept_mapping" in self.tables:
            mapping = self["concept_mapping"]
        else:
            mapping = lookups.concept_mapping(
                self["concept_reference_map"],
                self["concept_reference_term"],
                self["concept_reference_source"],
            )
        return Dictionary(mapping, self["concept_name"], self.local_source, self.locale)

    def encounter_type(self, uuid: str) -> Column:
        """The id of an encounter type, as a scalar subquery that reaches the scan filter."""
        types = self["encounter_type"].filter(F.col("uuid") == uuid)
        return types.agg(F.min("encounter_type_id")).scalar()

    def encounters(
        self,
        type_uuid: str | None = None,
        start: Day = None,
        end: Day = None,
        patient_id: int | None = None,
    ) -> DataFrame:
        """Live encounters of a type: one patient's, or those of a date range."""
        rows = self.active("encounter")
        if type_uuid is not None:
            rows = rows.filter(F.col("encounter_type") == self.encounter_type(type_uuid))
        return patient_or_range(rows, "encounter_datetime", start, end, patient_id)

    def live_patients(self) -> DataFrame:
        return self.active("patient").select("patient_id")

    def without_test_patients(self, df: DataFrame) -> DataFrame:
        """Drop patients flagged as test patients (the id is never null: a plain anti join)."""
        flagged = (
            self.active("person_attribute")
            .filter(
                (F.col("person_attribute_type_id") == self.test_patient_attribute)
                & (F.col("value") == "true")
            )
            .select(F.col("person_id").alias("patient_id"))
        )
        return df.join(flagged, "patient_id", "left_anti")

    # --- columns added by id -------------------------------------------------

    def people(self) -> DataFrame:
        """(patient_id, gender, birthdate) of live persons."""
        return self.active("person").select(
            F.col("person_id").alias("patient_id"), "gender", F.col("birthdate").cast("date")
        )

    def _of(self, name: str, column: str, wanted: DataFrame | None, key: str) -> DataFrame:
        """A table's rows of the ids that stand in ``wanted``, all rows when None.

        The semi join comes before any ranking and shares its partitioning, so a report ranks its own
        persons only.
        """
        if wanted is None:
            return self[name]
        ids = wanted.select(F.col(key).alias(column)).filter(F.col(column).isNotNull()).distinct()
        return self[name].join(ids, column, "left_semi")

    def names(self, patients: DataFrame | None = None) -> DataFrame:
        """The current name of all patients, or of those in ``patients``; so for the lookups below."""
        return lookups.latest_names(self._of("person_name", "person_id", patients, "patient_id")).select(
            F.col("person_id").alias("patient_id"), "given_name", "family_name"
        )

    def addresses(self, patients: DataFrame | None = None) -> DataFrame:
        """(patient_id, the address levels) of the current address."""
        return lookups.latest_addresses(self._of("person_address", "person_id", patients, "patient_id")).select(
            F.col("person_id").alias("patient_id"), *values.ADDRESS_LEVELS
        )

    def phones(self, name: str = "telephone", patients: DataFrame | None = None) -> DataFrame:
        return lookups.latest_attribute(
            self._of("person_attribute", "person_id", patients, "patient_id"), self.phone_attribute, name
        ).withColumnRenamed("person_id", "patient_id")

    def identifiers(self, type_uuid: str, name: str, patients: DataFrame | None = None) -> DataFrame:
        return lookups.latest_identifier(
            self._of("patient_identifier", "patient_id", patients, "patient_id"),
            self["patient_identifier_type"], type_uuid, name,
        )

    def with_location(self, df: DataFrame, column: str, name: str, spread: str) -> DataFrame:
        places = self["location"].select("location_id", F.col("name").alias(name))
        return left_lookup(df, places.withColumnRenamed("location_id", "_place"), column, "_place",
                           spread, FEW_IDS)

    def with_user_name(self, df: DataFrame, column: str, name: str, spread: str) -> DataFrame:
        users = lookups.user_names(self["users"], self["person_name"], name)
        return left_lookup(df, users, column, "user_id", spread, FEW_IDS)

    def providers(self, name: str = "provider", encounters: DataFrame | None = None) -> DataFrame:
        rows = self._of("encounter_provider", "encounter_id", encounters, "encounter_id")
        return lookups.encounter_providers(rows, self["provider"], name)
