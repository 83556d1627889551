"""Changes of stored tables by file: only files with rows that are due are read in full and written again.

A change of few rows of a large table costs one scan of the columns that tell which rows are due, and
the rewriting of their files. ``FileChange.result`` is the table as it will be; ``commit`` makes it so.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eavista.operators import migrate
from eavista.sources.swap import Files, Step, recover, staging_path, swap

_FILE = "_file_of_row"


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows with the name of the file each is in."""
    return spark.read.parquet(path).withColumn(_FILE, F.col("_metadata.file_path"))


@dataclass(frozen=True)
class FileChange:
    """``touched`` files are replaced by ``rows``, and ``added`` rows are appended; all other files stay.

    The file names are as many as the table has files, which Spark's driver lists anyway.
    """

    spark: SparkSession
    path: str
    files: Sequence[str]
    touched: Sequence[str]
    change: Callable[[DataFrame], DataFrame]
    added: DataFrame | None = None
    partitions: Sequence[str] = field(default=())

    def _read(self, files: Sequence[str]) -> DataFrame:
        schema = self.spark.read.parquet(self.path).schema
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*files)

    @property
    def untouched(self) -> list[str]:
        gone = set(self.touched)
        return [f for f in self.files if f not in gone]

    def _written(self) -> list[DataFrame]:
        """What has to be written, if anything."""
        rows = [self.change(self._read(self.touched))] if self.touched else []
        return rows + ([] if self.added is None else [self.added])

    def result(self) -> DataFrame:
        """The whole table after the change."""
        parts = ([self._read(self.untouched)] if self.untouched else []) + self._written()
        if not parts:
            return self.spark.read.parquet(self.path)
        return reduce(lambda a, b: a.unionByName(b.select(a.columns)), parts)

    def commit(self) -> None:
        """Write the changed files beside the table and swap them in."""
        recover(self.spark, self.path)
        written = self._written()
        if not written:
            return
        staged = staging_path(self.path)
        rows = reduce(lambda a, b: a.unionByName(b.select(a.columns)), written)
        writer = rows.write.partitionBy(*self.partitions) if self.partitions else rows.write
        writer.parquet(staged)
        steps = [Step(staged=f"{staged}/{name}", final=f"{self.path}/{_own_name(name)}") for name in _data_files(self.spark, staged)]
        swap(self.spark, self.path, staged, [*steps, *(Step(old=f) for f in self.touched)])


def _own_name(name: str) -> str:
    """A file name that no other change gives, in the same partition folder."""
    folder, _, file = name.rpartition("/")
    return f"{folder}/{uuid.uuid4().hex[:8]}-{file}" if folder else f"{uuid.uuid4().hex[:8]}-{file}"


def _data_files(spark: SparkSession, path: str, below: str = "") -> list[str]:
    """Data files below a folder, by their paths in it."""
    found, files = [], Files(spark, path)
    for name in files.names(f"{path}/{below}" if below else path):
        inside = f"{below}/{name}" if below else name
        if name.startswith(("_", ".")):
            continue
        found += [inside] if name.endswith(".parquet") else _data_files(spark, path, inside)
    return found


def _change(
    spark: SparkSession, path: str, touched: Sequence[str], change: Callable[[DataFrame], DataFrame],
    added: DataFrame | None = None, partitions: Sequence[str] = (),
) -> FileChange:
    files = map(_plain, spark.read.parquet(path).inputFiles())
    return FileChange(spark, path, sorted(files), sorted(touched), change, added, partitions)


def _plain(name: str) -> str:
    """A file name as it is read, from the encoded ones that Spark tells, with any number of slashes."""
    return unquote(re.sub("^file:/+", "file:/", name))


def _files(due: DataFrame) -> list[str]:
    return [_plain(r[0]) for r in due.select(_FILE).distinct().collect()]


def update_from(
    spark: SparkSession, path: str, changes: DataFrame, key: str, columns: Sequence[str], partitions: Sequence[str] = ()
) -> FileChange:
    """``migrate.update_from`` on the files that hold a key of ``changes``."""
    due = stored(spark, path).join(changes.select(key), key, "left_semi")
    return _change(spark, path, _files(due), lambda rows: migrate.update_from(rows, changes, key, columns), None, partitions)


def delete_matching(spark: SparkSession, path: str, keys: DataFrame, key: str, partitions: Sequence[str] = ()) -> FileChange:
    """``migrate.delete_matching`` on the files that hold one of the keys."""
    due = stored(spark, path).join(keys.select(key), key, "left_semi")
    return _change(spark, path, _files(due), lambda rows: migrate.delete_matching(rows, keys, key), None, partitions)


def recode_obs(
    spark: SparkSession, path: str, old: int, new: int, now: Column, new_uuid: Column | None = None,
    include_voided: bool = False, partitions: Sequence[str] = (),
) -> FileChange:
    """``migrate.recode_obs`` on the files with due rows; the copies are appended in files of their own.

    One aggregate with a row a file tells the files and the highest id.
    """
    due = migrate.due_for_recoding(old, include_voided)
    facts = stored(spark, path).groupBy(_FILE).agg(
        F.max("obs_id").alias("highest"), F.bool_or(due).alias("due")
    ).collect()
    touched = [_plain(r[_FILE]) for r in facts if r["due"]]
    if not touched:
        return _change(spark, path, [], lambda rows: rows, None, partitions)
    highest = max(r["highest"] for r in facts if r["highest"] is not None)
    rows = spark.read.schema(spark.read.parquet(path).schema).option("basePath", path).parquet(*touched)
    copies = migrate.recoded_copies(rows.filter(due), new, F.lit(highest), new_uuid)
    return _change(spark, path, touched, lambda part: migrate.voided_for_recoding(part, due, now), copies, partitions)
