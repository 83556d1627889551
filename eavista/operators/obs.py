"""Operators over entity–attribute–value observations.

``pivot_obs`` turns any number of concepts into columns with one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from eavista import values
from eavista.functions.text import fixed_map, quoted
from eavista.operators import naming
from eavista.operators.joins import left_lookup
from eavista.operators.lookups import Dictionary
from eavista.session import stage

OBS_COLUMNS = (
    "obs_id", "obs_group_id", "encounter_id", "person_id", "concept_id", "value_numeric",
    "value_coded", "value_drug", "value_datetime", "value_text", "comments", "date_created",
    "creator",
)

VALUE_COLUMNS = {
    "numeric": "value_numeric",
    "text": "value_text",
    "datetime": "value_datetime",
    "date": "value_datetime",
    "coded": "value_coded",
    "drug_id": "value_drug",
    "comment": "comments",
    "coded_list": "_name",
}
#: Kinds shown by a name: the picked id's column, and the name's column in the dictionary.
NAMED = {
    "drug": ("value_drug", "name"),
    "coded_name": ("value_coded", "name"),
    "coded_short_name": ("value_coded", "short_name"),
}
_POSITIVE = (1 << 62) - 1


# values of fixed width aggregate in place, in generated code; texts and lists do not
FIXED_WIDTH = {"numeric", "datetime", "date", "coded", "drug_id"}
WIDE = 20


@dataclass(frozen=True)
class Measure:
    """One output column: which concept, which typed value, which observation to take.

    ``concept`` is a concept id, or a dictionary code. With ``answer`` (an id or code) only
    observations with that coded answer count. ``pick`` is the newest or the first
    observation (by id) of the key; a ``coded_list`` joins all of them.
    """

    column: str
    concept: int | str
    kind: str = "numeric"
    answer: int | str | None = None
    pick: str = "newest"
    separator: str = values.LIST_SEPARATOR


def measures(rows: Sequence[tuple], pick: str = "newest") -> list[Measure]:
    """Measures from a fixed table of (column, code, kind[, answer code])."""
    return [Measure(r[0], r[1], r[2], r[3] if len(r) > 3 else None, pick) for r in rows]


def of_concepts(
    obs: DataFrame, codes: Sequence[int | str], dictionary: Dictionary | None = None
) -> DataFrame:
    """Observations of the named concepts (ids or codes), by a filter that the file scan can use."""
    known = [c for c in concept_ids(codes, dictionary).values() if c is not None]
    return obs.filter(F.col("concept_id").isin(*known)) if known else obs.filter("false")


def concept_ids(codes: Sequence[int | str], dictionary: Dictionary | None) -> dict[int | str, int | None]:
    """The concept id of each id (itself) or dictionary code."""
    named = [c for c in dict.fromkeys(codes) if not isinstance(c, int)]
    if named and dictionary is None:
        raise ValueError("dictionary codes need a dictionary")
    found = dictionary.ids(named) if named else {}
    return {c: c if isinstance(c, int) else found[c] for c in dict.fromkeys(codes)}


def narrow_obs(
    obs: DataFrame,
    *keys: DataFrame,
    key: str = "encounter_id",
    codes: Sequence[int | str] | None = None,
    dictionary: Dictionary | None = None,
) -> DataFrame:
    """Live observations of the selected encounters (or groups), each row once.

    Several selections are joined in one pass over the observations. With ``codes`` other
    concepts are dropped first, at the scan, before any row is shuffled.
    """
    wanted = reduce(DataFrame.unionByName, [k.select(key) for k in keys]).distinct()
    rows = obs.filter("voided = 0")
    if codes is not None:
        rows = of_concepts(rows, codes, dictionary)
    return rows.join(wanted, key, "left_semi")


def staged_obs(obs: DataFrame, name: str) -> DataFrame:
    """Narrowed observations written once for a report that reads them several times."""
    return stage(obs.select(*[c for c in OBS_COLUMNS if c in obs.columns]), name)


def ordered_list(value: str, separator: str, *order: str, where: str | None = None) -> Column:
    """Non-null values of a group as one text, in the given order."""
    kept = "" if where is None else f" FILTER (WHERE {where})"
    return F.expr(f"listagg({value}, {quoted(separator)}) WITHIN GROUP (ORDER BY {', '.join(order)}){kept}")


def pivot_obs(
    obs: DataFrame,
    key: str | Sequence[str],
    wanted: Sequence[Measure],
    dictionary: Dictionary | None = None,
    names: DataFrame | None = None,
    drugs: DataFrame | None = None,
    rows: DataFrame | None = None,
) -> DataFrame:
    """One row per key with one column per measure; with ``rows``, each of these rows with the measures of its key.

    All columns come from a single aggregation, so the cost does not grow by a shuffle per
    column. Observations of other concepts are dropped at the scan, and the partial aggregation
    keeps one value per key, column and map task. Coded values and drugs are picked as ids; only
    the picked ones are then given their names, so observations never meet the dictionary. Lists
    are made apart, from the rows of their concepts: as lists of ids, which get their names at the end. Picked
    answers of a large dictionary meet only the names in use, which are sent to the tasks where they are few, and ``rows``
    are joined before the names, where the pivot lies by their key.

    More than ``WIDE`` columns are made in two halves, numbers and texts: the numbers then
    stay in the hash aggregate, whose cost hardly grows with the columns, and the halves meet
    in a join on the key they are already partitioned by. Rows without a key are dropped.
    """
    keys = [key] if isinstance(key, str) else list(key)
    for k in keys:
        obs = obs.filter(F.col(k).isNotNull())
    ids = concept_ids([m.concept for m in wanted] + [m.answer for m in wanted if m.answer is not None], dictionary)
    lists = [m for m in wanted if m.kind == "coded_list"]
    single = [m for m in wanted if m.kind != "coded_list"]
    fixed = [m for m in single if m.kind in FIXED_WIDTH or m.kind in NAMED]
    other = [m for m in single if not (m.kind in FIXED_WIDTH or m.kind in NAMED)]
    parts = [fixed, other] if len(single) > WIDE else [single]
    if lists or {m.kind for m in single} & {"coded_name", "coded_short_name"}:
        names = dictionary.best_names() if names is None else names
    made = [_pivot(obs, keys, part, ids) for part in parts if part]
    coded = [m for m in single if m.kind in NAMED and m.kind != "drug"]
    small = (naming.is_small(names) if dictionary is None else dictionary.is_small()) if lists or coded else True
    if lists:
        made.append((_late_lists if small else _joined_lists)(obs, keys, lists, ids, names))
    joined = reduce(lambda a, b: a.join(b, keys, "full"), made)
    others = []
    if rows is not None:
        others = [c for c in rows.columns if c not in keys]
        joined = rows.join(joined, keys, "left")
    if coded and not small:
        answered = of_concepts(obs, [ids[m.concept] for m in coded if ids[m.concept] is not None])
        names = naming.used_names(answered, "value_coded", names, "concept_id")
    for m in single:
        if m.kind in NAMED:
            joined = _translated(joined, m, keys, drugs if m.kind == "drug" else names)
    return joined.select(*keys, *others, *[m.column for m in wanted])


def _late_lists(
    obs: DataFrame, keys: list[str], lists: Sequence[Measure], ids: dict[int | str, int | None], names: DataFrame
) -> DataFrame:
    """The lists of a small dictionary: ids are shuffled, distinct ids named once, and names put in place in the lists."""
    rows = of_concepts(obs, [ids[m.concept] for m in lists if ids[m.concept] is not None])
    index = naming.name_index(rows, "value_coded", names, "concept_id", "name")
    answers = [
        F.expr(f"array_sort(collect_list(struct(obs_id, value_coded)) FILTER (WHERE {_hit(m, ids)}))").alias(m.column)
        for m in lists
    ]
    made = rows.groupBy(*keys).agg(*answers).withColumn("_index", index)
    shown = []
    for m in lists:
        texts = F.array_compact(F.transform(m.column, lambda a: naming.named(F.col("_index"), a["value_coded"])))
        shown.append(F.when(F.size(texts) > 0, F.array_join(texts, m.separator)).alias(m.column))
    return made.select(*keys, *shown)


def _joined_lists(
    obs: DataFrame, keys: list[str], lists: Sequence[Measure], ids: dict[int | str, int | None], names: DataFrame
) -> DataFrame:
    """The lists of a large dictionary: rows meet their names in a join that deals hot answers to parts."""
    rows = of_concepts(obs, [ids[m.concept] for m in lists if ids[m.concept] is not None])
    rows = naming.with_name(rows, "value_coded", names, "concept_id", "name", "_name", "obs_id", small=False)
    return _pivot(rows, keys, lists, ids)


def _hit(m: Measure, ids: dict[int | str, int | None]) -> str:
    """The condition of a measure's observations."""
    if ids[m.concept] is None or m.answer is not None and ids[m.answer] is None:
        return "false"
    answer = "" if m.answer is None else f" AND value_coded = {ids[m.answer]}"
    return f"concept_id = {ids[m.concept]}{answer}"


def _translated(rows: DataFrame, m: Measure, keys: list[str], table: DataFrame) -> DataFrame:
    """The picked id of a measure replaced by its name."""
    id_column, shown = ("drug_id", "name") if m.kind == "drug" else ("concept_id", NAMED[m.kind][1])
    named = table.select(F.col(id_column).alias("_named"), F.col(shown).alias("_shown"))
    found = left_lookup(rows, named, m.column, "_named", F.xxhash64(*keys).bitwiseAND(_POSITIVE))
    return found.withColumn(m.column, F.col("_shown")).drop("_shown")


def _pivot(
    obs: DataFrame, keys: list[str], wanted: Sequence[Measure], ids: dict[int | str, int | None]
) -> DataFrame:
    def column(m: Measure) -> Column:
        value = NAMED[m.kind][0] if m.kind in NAMED else VALUE_COLUMNS[m.kind]
        hit = _hit(m, ids)
        if m.kind == "coded_list":
            return ordered_list(value, m.separator, "obs_id", where=hit).alias(m.column)
        pick = "max_by" if m.pick == "newest" else "min_by"
        picked = F.expr(f"{pick}({value}, obs_id) FILTER (WHERE {hit} AND {value} IS NOT NULL)")
        return (picked.cast("date") if m.kind == "date" else picked).alias(m.column)

    rows = of_concepts(obs, [ids[m.concept] for m in wanted if ids[m.concept] is not None])
    return rows.groupBy(*keys).agg(*[column(m) for m in wanted])


def group_totals(obs: DataFrame, name: str) -> DataFrame:
    """Sum of the numeric values per observation group.

    Joining drugs to this instead of to every numeric sibling gives the same sums without
    forming all pairs of a group.
    """
    return (
        obs.filter("obs_group_id IS NOT NULL AND value_numeric IS NOT NULL")
        .groupBy("obs_group_id")
        .agg(F.sum(F.col("value_numeric").cast("decimal(38,6)")).alias(name))
    )


def latest_marked_group(
    obs: DataFrame, marker: Column, date_concept: Column
) -> DataFrame:
    """Per encounter the newest dated group that contains a marker observation.

    (encounter_id, date, group): the latest date, and the highest group id at that date. Only
    groups with a marker can win.
    """
    marked = obs.filter(marker).filter("obs_group_id IS NOT NULL").select("obs_group_id").distinct()
    return (
        obs.filter(date_concept & F.col("value_datetime").isNotNull())
        .join(marked, "obs_group_id", "left_semi")
        .groupBy("encounter_id")
        .agg(F.max(F.struct("value_datetime", "obs_group_id")).alias("_top"))
        .select(
            "encounter_id",
            F.col("_top.value_datetime").cast("date").alias("date"),
            F.col("_top.obs_group_id").alias("group"),
        )
    )


def medication_lines(
    obs: DataFrame, dictionary: Dictionary, drugs: DataFrame
) -> DataFrame:
    """One row per medication group with its 16 columns; a group without children stays."""
    codes = {"group": values.MEDICATION_GROUP}
    parents = dictionary.only_role(obs, "concept_id", codes, "_role").select(
        "encounter_id", F.col("obs_id").alias("obs_group_id")
    )
    rows = [(c, code, kind, values.PARTS_OF_DAY.get(part)) for c, code, kind, part
            in values.MEDICATION_MEASURES]
    return pivot_obs(
        obs.filter("obs_group_id IS NOT NULL"), "obs_group_id", measures(rows, "first"),
        dictionary, drugs=drugs, rows=parents,
    )


def repeated_children(obs: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Groups in which a single-valued medication concept occurs more than once."""
    codes = {code: code for _, code, kind, _ in values.MEDICATION_MEASURES if kind != "comment"}
    return (
        dictionary.only_role(obs.filter("obs_group_id IS NOT NULL"), "concept_id", codes, "code")
        .groupBy("obs_group_id", "code")
        .agg(F.count("*").alias("occurrences"))
        .filter("occurrences > 1")
    )


def rapid_test_lines(obs: DataFrame, dictionary: Dictionary) -> DataFrame:
    """(encounter_id, obs_id, display_name) of the rapid tests that have a text.

    Blood typing shows the value; a suspicion shows only its name and only when affirmed; any
    other test shows its name and positive or negative.
    """
    tests = {code: code for code in values.RAPID_TESTS}
    answers = {"positive": values.POSITIVE, "negative": values.NEGATIVE, "yes": values.YES_SHARED}
    rows = dictionary.only_role(obs, "concept_id", tests, "_test")
    rows = dictionary.with_role(rows, "value_coded", answers, "_result")
    rows = dictionary.with_name(rows, "value_coded", "_value", "obs_id")
    label = F.try_element_at(fixed_map(values.RAPID_TESTS), F.col("_test"))
    suspected = F.col("_test").isin(*values.SUSPICIONS) & (F.col("_result") == "yes")
    shown = (
        F.when(suspected, label)
        .when(F.col("_test") == values.BLOOD_TYPING, F.concat(label, F.lit(": "), F.col("_value")))
        .when(F.col("_result") == "negative", F.concat(label, F.lit(values.NEGATIVE_WORD)))
        .when(F.col("_result") == "positive", F.concat(label, F.lit(values.POSITIVE_WORD)))
    )
    return rows.select("encounter_id", "obs_id", shown.alias("display_name")).filter(
        "display_name IS NOT NULL"
    )
