"""Changes of stored tables that are staged first and swapped in at the end.

A change is written beside the table, into a hidden folder of it. Then a journal names every step of the
swap, and the steps are done. Before the journal stands, a failure leaves the table as it was; after it,
``recover`` does the rest. Steps are renames and deletions of whole files or folders, on any file
system that Spark reads. One change of a table runs at a time, and readers see its files
while they are swapped, as with any overwrite of files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

_STAGED, _JOURNAL = "_staged-", "_swap-"


@dataclass(frozen=True)
class Step:
    """``old`` goes, then ``staged`` takes the place ``final``; either part may be missing."""

    old: str | None = None
    staged: str | None = None
    final: str | None = None


class Files:
    """The file system of a path, by plain calls."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._read = spark._jvm.org.apache.commons.io.IOUtils.toString
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names inside a folder; none if it is not there."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path))) if self.exists(path) else []

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        parent = self._path(target).getParent()
        self._fs.mkdirs(parent)
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} can not be moved to {target}")

    def write(self, path: str, text: str) -> None:
        """The whole file or none: written under another name first."""
        unready = f"{path}.unready"
        out = self._fs.create(self._path(unready), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(unready, path)

    def read(self, path: str) -> str:
        source = self._fs.open(self._path(path))
        try:
            return self._read(source, "UTF-8")
        finally:
            source.close()


def staging_path(table: str) -> str:
    """A new hidden folder of a table."""
    return f"{table.rstrip('/')}/{_STAGED}{uuid.uuid4().hex}"


def swap(spark: SparkSession, table: str, staged: str, steps: Iterable[Step]) -> None:
    """Do the steps of a change staged in the folder ``staged`` of a table; all of them, sooner or later."""
    files = Files(spark, table)
    journal = f"{table.rstrip('/')}/{_JOURNAL}{uuid.uuid4().hex}"
    files.write(journal, json.dumps({"staged": staged, "steps": [asdict(s) for s in steps]}))
    _finish(files, journal)


def _finish(files: Files, journal: str) -> None:
    content = json.loads(files.read(journal))
    for step in (Step(**s) for s in content["steps"]):
        # A step whose staged part has moved is done: what stands at its place is the new one.
        if step.staged is not None and not files.exists(step.staged):
            continue
        if step.old is not None:
            files.remove(step.old)
        if step.staged is not None:
            files.move(step.staged, step.final)
    files.remove(content["staged"])
    files.remove(journal)


def recover(spark: SparkSession, table: str) -> None:
    """End what an earlier change left: journalled swaps are finished, staged parts without a journal go."""
    table = table.rstrip("/")
    files = Files(spark, table)
    for name in files.names(table):
        if name.startswith(_JOURNAL) and not name.endswith(".unready"):
            _finish(files, f"{table}/{name}")
    for name in files.names(table):
        if name.startswith((_STAGED, _JOURNAL)):
            files.remove(f"{table}/{name}")
