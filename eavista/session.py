"""Session helpers: shared scratch space and reliable checkpoints."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from eavista.functions.text import quoted

CHECKPOINT_CONF = "spark.checkpoint.dir"


#: Paths that the open ``scratch`` blocks have to remove, innermost last.
_OWNED: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; on one machine only, else a folder below the warehouse."""
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"name a folder that all executors share in {CHECKPOINT_CONF}")
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _OWNED:
        _OWNED[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reads, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owns the tables staged inside the block and removes them at its end.

    ``with scratch(spark): report(...).write.parquet(out)`` leaves nothing but ``out``. Without a
    block, staged tables stay until the shared folder is cleaned.
    """
    _OWNED.append([])
    try:
        yield
    finally:
        for path in _OWNED.pop():
            remove(spark, path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage (survives lost executors)."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def _sql_literal(value) -> str:
    return "NULL" if value is None else quoted(value) if isinstance(value, str) else str(value)


def literal_table(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A small in-code table. ``columns`` is a DDL string such as ``"code string, label string"``."""
    fields = [c.strip().split(" ") for c in columns.split(",")]
    tuples = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in fields)
    names = ", ".join(name for name, _ in fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {tuples} AS t({names})")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, for plans that use it often.

    Several consumers of one narrowed table would each scan the source again. Reading the
    written copy is columnar, so every consumer still reads only its own columns.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
