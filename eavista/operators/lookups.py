"""Dictionary and people lookups as dimension joins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from eavista import values
from eavista.operators import naming
from eavista.operators.filters import active
from eavista.operators.joins import FEW_IDS, left_lookup
from eavista.operators.latest import latest_per_key, newest
from eavista.session import literal_table


def concept_mapping(
    reference_map: DataFrame,
    term: DataFrame,
    source: DataFrame,
    sources: Sequence[str] | None = None,
) -> DataFrame:
    """(concept_id, source, code) of the live terms, optionally of some sources only."""
    source = active(source).select("concept_source_id", F.col("name").alias("source"))
    if sources is not None:
        source = source.filter(F.col("source").isin(*sources))
    term = active(term).select("concept_reference_term_id", "concept_source_id", "code")
    return (
        reference_map.select("concept_id", "concept_reference_term_id")
        .join(term, "concept_reference_term_id")
        .join(source, "concept_source_id")
        .select("concept_id", "source", "code")
    )


def best_names(names: DataFrame, locale: str) -> DataFrame:
    """One full and one short name per concept: (concept_id, name, short_name).

    A name of the wanted locale comes first, then the preferred one, then the smallest id;
    names of other locales fill in.
    """
    short = F.coalesce(F.col("concept_name_type") == "SHORT", F.lit(False))
    rank = F.struct(
        (F.col("locale") != locale).alias("foreign"),
        (-F.coalesce(F.col("locale_preferred"), F.lit(0))).alias("rejected"),
        F.col("concept_name_id"),
    )
    return (
        active(names)
        .groupBy("concept_id")
        .agg(
            F.min_by(F.when(~short, F.col("name")), F.when(~short, rank)).alias("name"),
            F.min_by(F.when(short, F.col("name")), F.when(short, rank)).alias("short_name"),
        )
    )


@dataclass(frozen=True)
class Dictionary:
    """The concept dictionary as seen by one deployment.

    ``mapping`` has (concept_id, source, code) and ``names`` the concept name rows.
    ``local_source`` is the mapping source meant by codes without a source prefix.
    """

    mapping: DataFrame
    names: DataFrame
    local_source: str = "LOCAL"
    locale: str = values.DEFAULT_LOCALE
    _known: dict[str, int | None] = field(default_factory=dict, init=False, repr=False, compare=False)
    _small: dict[str, bool] = field(default_factory=dict, init=False, repr=False, compare=False)

    def split(self, code: str | int) -> tuple[str, str]:
        """``CIEL:21`` is a code of that source; a bare code belongs to the local source."""
        source, colon, rest = str(code).partition(":")
        return (source, rest) if colon else (self.local_source, str(code))

    def resolve(self, codes: Mapping[str, str | int]) -> DataFrame:
        """(role, concept_id) for a mapping role → code; an unknown code has no row.

        Codes compare without case. At most one row per role, so the result never has more
        rows than ``codes`` has entries, and it is marked for broadcast.
        """
        spark = self.mapping.sparkSession
        wanted = literal_table(
            spark,
            "role string, source string, code_key string",
            [(role, *(x for x in self._wanted(code))) for role, code in codes.items()],
        )
        found = (
            self.mapping.withColumn("code_key", F.lower("code"))
            .join(F.broadcast(wanted), ["source", "code_key"])
            .groupBy("role")
            .agg(F.min("concept_id").alias("concept_id"))
        )
        return F.broadcast(found)

    def _wanted(self, code: str | int) -> tuple[str, str]:
        source, text = self.split(code)
        return source, text.lower()

    def ids(self, codes: Iterable[str | int]) -> dict[str, int | None]:
        """Concept id of each code, None for an unknown one.

        Codes are read together and remembered, at most one row a code, so that plans hold plain
        ids: filters on them reach the file scan and no dictionary table is joined.
        """
        new = [c for c in dict.fromkeys(map(str, codes)) if c not in self._known]
        if new:
            rows = self.resolve({code: code for code in new}).collect()
            self._known.update(dict.fromkeys(new), **{r["role"]: r["concept_id"] for r in rows})
        return {str(c): self._known[str(c)] for c in codes}

    def ambiguous(self, codes: Mapping[str, str | int]) -> DataFrame:
        """(role, concepts): roles whose code names several concepts, of which the smallest id counts."""
        wanted = literal_table(
            self.mapping.sparkSession, "role string, source string, code_key string",
            [(role, *self._wanted(code)) for role, code in codes.items()],
        )
        found = self.mapping.withColumn("code_key", F.lower("code")).join(F.broadcast(wanted), ["source", "code_key"])
        return found.groupBy("role").agg(F.count_distinct("concept_id").alias("concepts")).filter("concepts > 1")

    def unresolved(self, codes: Mapping[str, str | int]) -> DataFrame:
        """The roles whose code is not in the dictionary, for a warning table."""
        spark = self.mapping.sparkSession
        wanted = literal_table(
            spark,
            "role string, source string, code string",
            [(role, *self.split(code)) for role, code in codes.items()],
        )
        return wanted.join(self.resolve(codes), "role", "left_anti")

    def concept(self, code: str | int) -> Column:
        """The concept id of one code, as a scalar subquery."""
        source, text = self._wanted(code)
        return (
            self.mapping.filter((F.col("source") == source) & (F.lower("code") == text))
            .agg(F.min("concept_id"))
            .scalar()
        )

    def best_names(self) -> DataFrame:
        return best_names(self.names, self.locale)

    def is_small(self, table: str = "names") -> bool:
        """Whether ``names`` (or ``mapping``) may be sent to the tasks; counted once."""
        if table not in self._small:
            self._small[table] = naming.is_small(getattr(self, table))
        return self._small[table]

    def with_name(self, df: DataFrame, column: str, name: str, spread: str) -> DataFrame:
        """Add the displayed name of the coded ``column``."""
        return naming.with_name(df, column, self.best_names(), "concept_id", "name", name, spread, self.is_small())

    def with_code(self, df: DataFrame, column: str, source: str, name: str, spread: str) -> DataFrame:
        """Add one code of the source for the coded ``column``."""
        codes = self.codes_of(source)
        return naming.with_name(df, column, codes, "concept_id", "code", name, spread, self.is_small("mapping"))

    def name_of(self, code: str | int) -> Column:
        """The displayed name of one code, as a scalar subquery."""
        named = self.best_names().join(self.resolve({"it": code}), "concept_id")
        return named.agg(F.max("name")).scalar()

    def codes_of(self, source: str, pick: str = "min") -> DataFrame:
        """(concept_id, code) with one code of the source per concept."""
        return (
            self.mapping.filter(F.col("source") == source)
            .groupBy("concept_id")
            .agg(getattr(F, pick)("code").alias("code"))
        )

    def with_role(self, df: DataFrame, column: str, codes: Mapping[str, str | int], name: str
                  ) -> DataFrame:
        """Add the role of the coded ``column`` as ``name``; null for other concepts.

        A concept of several roles gives a row for each.
        """
        roles: dict[int, list[str]] = {}
        found = self.ids(codes.values())
        for role, code in codes.items():
            if found[str(code)] is not None:
                roles.setdefault(found[str(code)], []).append(role)
        if any(len(r) > 1 for r in roles.values()):
            rows = [(role, concept) for concept, own in roles.items() for role in own]
            table = literal_table(df.sparkSession, "_role string, _concept int", rows)
            joined = df.join(F.broadcast(table), F.col(column) == F.col("_concept"), "left")
            return joined.withColumnRenamed("_role", name).drop("_concept")
        chosen = F.lit(None).cast("string")
        for concept, (role,) in roles.items():
            chosen = F.when(F.col(column) == concept, role).otherwise(chosen)
        return df.withColumn(name, chosen)

    def only_role(self, df: DataFrame, column: str, codes: Mapping[str, str | int], name: str
                  ) -> DataFrame:
        """Like ``with_role``, keeping only the rows whose concept has a role."""
        known = sorted({c for c in self.ids(codes.values()).values() if c is not None})
        rows = df.filter(F.col(column).isin(*known)) if known else df.filter("false")
        return self.with_role(rows, column, codes, name)


def latest_names(person_name: DataFrame) -> DataFrame:
    """Current name per person: preferred first, then the newest, then the highest id."""
    return latest_per_key(
        active(person_name), "person_id", *newest("preferred", "date_created", "person_name_id")
    )


def latest_addresses(person_address: DataFrame) -> DataFrame:
    return latest_per_key(
        active(person_address),
        "person_id",
        *newest("preferred", "date_created", "person_address_id"),
    )


def latest_attribute(person_attribute: DataFrame, attribute_type: int, name: str) -> DataFrame:
    """(person_id, value) of the newest attribute row of one type, for example the phone."""
    rows = active(person_attribute).filter(F.col("person_attribute_type_id") == attribute_type)
    return latest_per_key(
        rows, "person_id", *newest("date_created", "person_attribute_id")
    ).select("person_id", F.col("value").alias(name))


def latest_identifier(
    patient_identifier: DataFrame, identifier_type: DataFrame, type_uuid: str, name: str
) -> DataFrame:
    """(patient_id, identifier) of one identifier type: preferred first, then the newest."""
    wanted = identifier_type.filter(F.col("uuid") == type_uuid)
    type_id = wanted.agg(F.min("patient_identifier_type_id")).scalar()
    rows = active(patient_identifier).filter(F.col("identifier_type") == type_id)
    return latest_per_key(
        rows, "patient_id", *newest("preferred", "date_created", "patient_identifier_id")
    ).select("patient_id", F.col("identifier").alias(name))


def full_name() -> Column:
    return F.trim(F.concat_ws(" ", "given_name", "family_name"))


def user_names(users: DataFrame, person_name: DataFrame, name: str) -> DataFrame:
    """(user_id, name) through the user's person; only the names of users are ranked."""
    own = person_name.join(users.select("person_id").distinct(), "person_id", "left_semi")
    names = latest_names(own).select("person_id", full_name().alias(name))
    return users.select("user_id", "person_id").join(names, "person_id").select("user_id", name)


def encounter_providers(encounter_provider: DataFrame, provider: DataFrame, name: str) -> DataFrame:
    """(encounter_id, name) of the first provider of each encounter."""
    first = latest_per_key(
        active(encounter_provider), "encounter_id", F.col("encounter_provider_id").asc()
    )
    people = provider.select(F.col("provider_id").alias("_provider"), F.col("name").alias(name))
    return left_lookup(first, people, "provider_id", "_provider", "encounter_id", FEW_IDS).select("encounter_id", name)


def global_property(properties: DataFrame, key: str, default: str) -> Column:
    """A setting as a scalar subquery, or the default."""
    value = properties.filter(F.col("property") == key).agg(F.max("property_value")).scalar()
    return F.coalesce(value, F.lit(default))


def current_name_address(
    person: DataFrame, person_name: DataFrame, person_address: DataFrame
) -> DataFrame:
    """One row per live person with the current name and address, under the view's names."""
    name = latest_names(person_name).select(
        "person_id", "given_name", "family_name", F.col("middle_name").alias("nick_name")
    )
    address = latest_addresses(person_address).select(
        "person_id",
        "person_address_id",
        "country",
        F.col("state_province").alias("department"),
        F.col("city_village").alias("commune"),
        F.col("address3").alias("section_communal"),
        F.col("address1").alias("locality"),
        F.col("address2").alias("street_landmark"),
    )
    return (
        active(person)
        .select("person_id", "gender", "birthdate", "birthdate_estimated")
        .join(name, "person_id", "left")
        .join(address, "person_id", "left")
    )
