"""Site tables and the partitioned warehouse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eavista import values
from eavista.operators.filters import active
from eavista.sources.swap import Files, Step, recover, staging_path, swap

ENCOUNTER_EXTRACT = T.StructType(
    [
        T.StructField("patient_id", T.IntegerType()),
        T.StructField("encounter_id", T.IntegerType()),
        T.StructField("encounter_type", T.IntegerType()),
    ]
)


def split_points(ids: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list[int]:
    """At most ``parts - 1`` ids that cut the rows into parts of about equal size, from one aggregated sketch.

    ``ids`` is any table with the column: the last load of the site, say, as ids rarely move. No point
    stands twice; nulls are left out.
    """
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    found = ids.agg(F.percentile_approx(column, shares, accuracy).alias("points")).first()["points"]
    return sorted(set(found or []))


def split_predicates(column: str, points: Sequence[int]) -> list[str]:
    """One condition a part: every row, also one with a null or a new id, meets exactly one of them."""
    if not points:
        return ["1 = 1"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(points, points[1:])]
    return [f"{column} < {points[0]} OR {column} IS NULL", *inner, f"{column} >= {points[-1]}"]


def read_site_query(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str,
    points: Sequence[int],
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A query result of one site database, read in parallel: one task between two of the ``points``.

    Points from ``split_points`` give tasks of about equal size also where ids have gaps or lie
    close together in places; even ranges would not.
    """
    return spark.read.jdbc(
        url,
        f"({query}) AS extract",
        predicates=split_predicates(partition_column, points),
        properties={"fetchsize": "10000", **(properties or {})},
    )


def with_declared_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns and types; a missing column is an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def extract(
    table: DataFrame, columns: Mapping[str, str], where: Column | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """A site's extraction from any source, JDBC or files: rows, renamed columns, declared types."""
    rows = table if where is None else table.filter(where)
    rows = rows.select(*[F.col(source).alias(name) for name, source in columns.items()])
    return rows if schema is None else with_declared_schema(rows, schema)


def encounter_extract(encounter: DataFrame, rows: int | None = 10) -> DataFrame:
    """The smoke extraction: live encounters, the first ``rows`` by id (all when None)."""
    columns = {f.name: f.name for f in ENCOUNTER_EXTRACT}
    live = extract(active(encounter), columns, schema=ENCOUNTER_EXTRACT)
    return live if rows is None else live.orderBy("encounter_id").limit(rows)


def consolidate(
    per_site: Mapping[str, DataFrame], partition_numbers: Mapping[str, int] = values.SITES
) -> DataFrame:
    """All sites' rows in one table with the site name and its partition number."""
    unknown = sorted(set(per_site) - set(partition_numbers))
    if unknown:
        raise ValueError(f"no partition number for: {', '.join(unknown)}")
    labelled = [
        df.withColumns(
            {"site": F.lit(site), "partition_num": F.lit(partition_numbers[site]).cast("int")}
        )
        for site, df in per_site.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), labelled)


def range_partition(value: Column, last: int = values.LAST_PARTITION_BOUNDARY) -> Column:
    """Number of the partition for boundaries 1 … last: the first boundary ≥ value, else last + 1."""
    return F.least(F.greatest(value, F.lit(1)), F.lit(last + 1)).cast("int")


def overwrite_partitions(
    df: DataFrame, path: str, column: str = "partition_num", loaded: Sequence[int] = ()
) -> None:
    """Replace the partitions that occur in ``df`` and those in ``loaded``; the others stay as they are.

    ``loaded`` names the partitions of all sites that were read, so that a site which yielded no
    rows loses its old ones. The rows are computed once and staged beside the table; which partitions
    are filled is seen from what was staged. Then whole partitions are swapped: a run that fails
    before that leaves all old partitions, one that fails in between is finished by the next one.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    recover(spark, path)
    staged = staging_path(path)
    df.write.partitionBy(column).parquet(staged)
    filled = [name for name in Files(spark, staged).names(staged) if name.startswith(f"{column}=")]
    steps = [Step(f"{path}/{name}", f"{staged}/{name}", f"{path}/{name}") for name in filled]
    emptied = {f"{column}={number}" for number in loaded} - set(filled)
    swap(spark, path, staged, [*steps, *(Step(f"{path}/{name}") for name in sorted(emptied))])
