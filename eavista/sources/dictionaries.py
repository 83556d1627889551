"""Concept, set, location, program and address dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eavista import values
from eavista.session import checkpoint

CONCEPT_COLUMNS = {
    "uuid": "uuid",
    "Void/Retire": "retired",
    "Fully specified name:en": "name_en",
    "Fully specified name:es": "name_es",
    "Short name:en": "short_name_en",
    "Short name:es": "short_name_es",
    "Description:en": "description",
    "Data class": "class",
    "Data type": "datatype",
    "Answers": "answers",
}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A dictionary file as text columns; a trailing load-order column is not data."""
    df = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)
    return df.drop(*[c for c in df.columns if c.startswith("_order")])


def is_true(col: Column) -> Column:
    return F.coalesce(F.lower(F.trim(col)).isin("true", "1"), F.lit(False))


def concepts(files: Sequence[DataFrame]) -> DataFrame:
    """All concept files as one table with plain column names; retired is a flag."""

    def one(df: DataFrame) -> DataFrame:
        known = {c.lower(): c for c in df.columns}
        return df.select(
            *[
                F.trim(F.col(f"`{known[header.lower()]}`")).alias(name)
                if header.lower() in known
                else F.lit(None).cast("string").alias(name)
                for header, name in CONCEPT_COLUMNS.items()
            ]
        )

    table = reduce(lambda a, b: a.unionByName(b), [one(f) for f in files])
    return table.withColumn("retired", is_true(F.col("retired")).cast("int"))


def unpivot_mappings(df: DataFrame, id_column: str = "uuid") -> DataFrame:
    """Columns ``Mappings|relation|source[|kind]`` as rows (id, relation, source, code).

    A cell may hold several codes separated by ``;``. A source name may end in `` 2nd`` when
    the file repeats a column.
    """
    columns = [c for c in df.columns if c.startswith("Mappings|") and c.count("|") >= 2]
    long = df.select(id_column, *[F.col(f"`{c}`").cast("string") for c in columns]).unpivot(
        id_column, [F.col(f"`{c}`") for c in columns], "_header", "_cell"
    )
    parts = F.split("_header", r"\|")
    return (
        long.filter("_cell IS NOT NULL")
        .select(
            id_column,
            parts[1].alias("relation"),
            F.regexp_replace(parts[2], " 2nd$", "").alias("source"),
            F.explode(F.split("_cell", ";")).alias("code"),
        )
        .withColumn("code", F.trim("code"))
        .filter("code <> ''")
    )


def explode_answers(df: DataFrame, id_column: str, cell: str) -> DataFrame:
    """An answer list ``No;Yes`` as rows (id, position from 1, answer)."""
    return df.select(
        id_column, F.posexplode(F.split(cell, ";")).alias("_at", "answer")
    ).select(id_column, (F.col("_at") + 1).alias("position"), F.trim("answer").alias("answer"))


def concept_sets(files: Sequence[DataFrame]) -> DataFrame:
    """Set files as edges (set_name, member, sort_weight, retired, position in the set)."""
    table = reduce(
        lambda a, b: a.unionByName(b),
        [
            f.select(
                F.trim("Concept").alias("set_name"),
                F.trim("Member").alias("member"),
                F.col("Sort Weight").cast("double").alias("sort_weight"),
                is_true(F.col("`Void/Retire`")).cast("int").alias("retired"),
            )
            for f in files
        ],
    )
    place = Window.partitionBy("set_name").orderBy("sort_weight", "member")
    return table.withColumn("position", F.row_number().over(place))


def set_closure(edges: DataFrame, parent: str, child: str, root: Column | None = None) -> DataFrame:
    """(root, member, depth, leaf): everything reachable from each set, or from one root.

    Sets may contain sets. A member reached on several ways counts once, at its smallest
    depth; a set that contains itself does not loop. Links without an end are left out.

    Pairs of sets are doubled: a shortest way longer than ``span`` goes through the set that it meets after
    exactly ``span`` links, so one join of those pairs with all known ones finds every depth up to twice the
    span. Rounds grow with the logarithm of the depth, and a pair is made in its own round only.
    Members that are no sets, most of them all, are added once at the end.
    """
    links = edges.select(F.col(parent).alias("parent"), F.col(child).alias("child")).dropna().distinct()
    links = checkpoint(links)
    sets = links.select(F.col("parent").alias("child")).distinct()
    reached = checkpoint(
        links.join(sets, "child", "left_semi")
        .select(F.col("parent").alias("root"), F.col("child").alias("member"), F.lit(1).cast("long").alias("depth"))
    )
    span = 1
    while not (ahead := reached.filter(F.col("depth") == span)).isEmpty():
        further = reached.select(F.col("root").alias("_by"), "member", F.col("depth").alias("_more"))
        found = (
            ahead.select("root", F.col("member").alias("_by")).join(further, "_by").filter("member <> root")
            .groupBy("root", "member").agg((F.min("_more") + span).alias("depth"))
        )
        reached = reached.unionByName(checkpoint(found.join(reached, ["root", "member"], "left_anti")))
        span *= 2
    roots = links.select(F.col("parent").alias("root")).distinct()
    if root is not None:
        reached, roots = (df.filter(F.col("root") == root) for df in (reached, roots))
    holders = reached.unionByName(roots.select("root", F.col("root").alias("member"), F.lit(0).cast("long").alias("depth")))
    leaves = (
        links.join(sets, "child", "left_anti")
        .join(holders.select("root", F.col("member").alias("parent"), "depth"), "parent")
        .groupBy("root", F.col("child").alias("member")).agg((F.min("depth") + 1).alias("depth"))
    )
    shown = [(reached, False), (leaves, True)]
    return reduce(DataFrame.unionByName, [
        df.select("root", "member", F.col("depth").cast("int").alias("depth"), F.lit(leaf).alias("leaf")) for df, leaf in shown
    ])


def unresolved_members(
    members: DataFrame, names: DataFrame, mapping: DataFrame, member: str = "member"
) -> DataFrame:
    """Set members that name no concept, neither by name nor as ``SOURCE:code``.

    Names compare without case and outer spaces. ``names`` has ``name``, ``mapping`` has
    ``source`` and ``code``.
    """
    known = names.select(F.lower(F.trim("name")).alias("_name")).distinct()
    codes = mapping.select(F.lower(F.concat("source", F.lit(":"), "code")).alias("_name")).distinct()
    return (
        members.withColumn("_name", F.lower(F.trim(member)))
        .join(known, "_name", "left_anti")
        .join(codes, "_name", "left_anti")
        .select(members.columns)
    )


def retired_disagreements(members: DataFrame, concepts: DataFrame) -> DataFrame:
    """Members whose retired flag no concept of their name shares."""
    flags = concepts.groupBy(F.lower(F.trim("name")).alias("_name")).agg(
        F.min("retired").alias("_low"), F.max("retired").alias("_high")
    )
    return (
        members.withColumn("_name", F.lower(F.trim("member")))
        .join(flags, "_name")
        .filter(~F.col("retired").between(F.col("_low"), F.col("_high")))
        .select(members.columns)
    )


def location_tags(df: DataFrame, keys: Sequence[str], tags: Mapping[str, str]) -> DataFrame:
    """Tag columns as rows (keys, tag) where the cell is TRUE; ``tags`` maps column → tag."""
    long = df.select(*keys, *[F.col(f"`{c}`").cast("string").alias(t) for c, t in tags.items()])
    return (
        long.unpivot(list(keys), list(tags.values()), "tag", "_cell")
        .filter(is_true(F.col("_cell")))
        .drop("_cell")
    )


def locations(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A location file as (location with the parent's uuid, location tags)."""
    base = df.select(
        F.col("UUID").alias("uuid"), F.trim("Name").alias("name"),
        F.col("Description").alias("description"), F.trim("Parent").alias("parent"),
    )
    parents = base.select(F.col("uuid").alias("parent_uuid"), F.col("name").alias("parent"))
    tags = {c: c.split("|", 1)[1] for c in df.columns if c.startswith("Tag|")}
    tagged = location_tags(df.withColumnRenamed("UUID", "uuid"), ["uuid"], tags)
    return base.join(parents, "parent", "left"), tagged


def split_reference(col: Column) -> tuple[Column, Column]:
    """``SOURCE:code`` as (source, code)."""
    return F.split_part(col, F.lit(":"), F.lit(1)), F.split_part(col, F.lit(":"), F.lit(2))


def with_reference(df: DataFrame, column: str, mapping: DataFrame, name: str) -> DataFrame:
    """Add the concept id of a ``SOURCE:code`` cell as ``name``; null when it is unknown."""
    ids = mapping.groupBy(
        F.col("source").alias("_source"), F.lower("code").alias("_code")
    ).agg(F.min("concept_id").alias(name))
    source, code = split_reference(F.col(column))
    return (
        df.withColumns({"_source": source, "_code": F.lower(code)})
        .join(ids, ["_source", "_code"], "left")
        .drop("_source", "_code")
    )


def programs(
    program: DataFrame, workflow: DataFrame, state: DataFrame, mapping: DataFrame
) -> DataFrame:
    """Program, workflow and state files joined, with their concepts resolved.

    A workflow names its program by uuid. A state names its workflow by uuid or by the
    workflow's concept reference.
    """
    top = with_reference(
        program.select(
            F.col("Uuid").alias("program_uuid"), F.col("Name").alias("program"),
            is_true(F.col("`Void/Retire`")).cast("int").alias("program_retired"),
            F.col("Program concept").alias("program_reference"),
            F.col("Outcomes concept").alias("outcome_reference"),
        ),
        "program_reference", mapping, "program_concept_id",
    )
    top = with_reference(top, "outcome_reference", mapping, "outcome_concept_id")
    middle = with_reference(
        workflow.select(
            F.col("Uuid").alias("workflow_uuid"), F.col("Program").alias("program_uuid"),
            F.col("Workflow concept").alias("workflow_reference"),
        ),
        "workflow_reference", mapping, "workflow_concept_id",
    )
    low = with_reference(
        state.select(
            F.col("Uuid").alias("state_uuid"), F.col("Workflow").alias("_workflow"),
            F.col("State concept").alias("state_reference"),
            is_true(F.col("Initial")).alias("initial"), is_true(F.col("Terminal")).alias("terminal"),
        ),
        "state_reference", mapping, "state_concept_id",
    )
    by_name = middle.groupBy("workflow_reference").agg(F.min("workflow_uuid").alias("_uuid"))
    low = (
        low.join(by_name, low["_workflow"] == by_name["workflow_reference"], "left")
        .withColumn("workflow_uuid", F.coalesce("_uuid", "_workflow"))
        .drop("workflow_reference", "_uuid", "_workflow")
    )
    return top.join(middle, "program_uuid", "left").join(low, "workflow_uuid", "left")


def resolve_placeholders(df: DataFrame, column: str, constants: DataFrame) -> DataFrame:
    """Replace a cell ``${a.b.uuid}`` by its constant; other cells and unknown names stay.

    ``constants`` has one row (name, value) per dotted path.
    """
    name = F.regexp_extract(column, r"^\$\{([^}]+)\}$", 1)
    values_ = constants.select(F.col("name").alias("_name"), F.col("value").alias("_value"))
    return (
        df.withColumn("_name", F.nullif(name, F.lit("")))
        .join(values_, "_name", "left")
        .withColumn(column, F.coalesce("_value", column))
        .drop("_name", "_value")
    )


def flatten_constants(tree: Mapping, prefix: str = "") -> list[tuple[str, str]]:
    """Nested constants as (dotted path, value) rows."""
    rows: list[tuple[str, str]] = []
    for key, value in tree.items():
        path = f"{prefix}.{key}" if prefix else str(key)
        rows += flatten_constants(value, path) if isinstance(value, Mapping) else [(path, str(value))]
    return rows


def with_format_check(
    identifiers: DataFrame, types: DataFrame, name: str = "valid"
) -> DataFrame:
    """``name`` is true when the identifier matches its type's whole format, or there is none."""
    formats = types.select(
        F.col("patient_identifier_type_id").alias("identifier_type"), F.col("format").alias("_format")
    )
    whole = F.concat(F.lit("^(?:"), F.col("_format"), F.lit(")$"))
    unchecked = F.col("_format").isNull() | (F.col("_format") == "")
    return (
        identifiers.join(formats, "identifier_type", "left")
        .withColumn(name, unchecked | F.rlike("identifier", whole))
        .drop("_format")
    )


def _cells(line: str) -> Column:
    return F.split(line, "\\" + values.ADDRESS_ENTRY_DELIMITER)


def _cell_part(cell: Column, part: int) -> Column:
    return F.trim(F.split_part(cell, F.lit(values.ADDRESS_IDENTIFIER_DELIMITER), F.lit(part)))


def split_hierarchy(df: DataFrame, line: str) -> DataFrame:
    """Hierarchy lines as entries: (depth, level, name, identifier, parent_path, path).

    An entry may carry an identifier after ``^``. Shared upper levels appear once.
    """
    level_names = F.array(*[F.lit(v) for v in values.ADDRESS_LEVELS])
    names = F.transform(_cells(line), lambda c: _cell_part(c, 1))
    entry = df.select(names.alias("_names"), F.posexplode(_cells(line)).alias("_at", "_cell"))
    entry = entry.filter(_cell_part(F.col("_cell"), 1) != "")
    at, separator = F.col("_at"), values.ADDRESS_ENTRY_DELIMITER
    return entry.select(
        (at + 1).alias("depth"),
        F.try_element_at(level_names, at + 1).alias("level"),
        F.get("_names", at).alias("name"),
        F.nullif(_cell_part(F.col("_cell"), 2), F.lit("")).alias("identifier"),
        F.array_join(F.slice("_names", F.lit(1), at), separator).alias("parent_path"),
        F.array_join(F.slice("_names", F.lit(1), at + 1), separator).alias("path"),
    ).distinct()


def missing_required_levels(df: DataFrame, line: str) -> DataFrame:
    """Lines that leave a required level of the hierarchy empty."""
    cells = _cells(line)
    empty = [
        F.coalesce(F.trim(F.get(cells, values.ADDRESS_LEVELS.index(level))), F.lit("")) == ""
        for level in values.REQUIRED_ADDRESS_LEVELS
    ]
    return df.filter(reduce(lambda a, b: a | b, empty))
