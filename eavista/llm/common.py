"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a run of characters other than the six ASCII spaces.
SPACES = " \\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(df: DataFrame) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(df["text"].cast("string"), F.lit(""))


#: Rows sent to a Python worker at a time, which bounds its memory; a session's smaller value stays.
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's batch size to ``BATCH_ROWS``: the default suits narrow rows, not whole texts."""
    now = int(spark.conf.get(_BATCH_CONF, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), lambda bound: body(bound)), 1)


def packed(df: DataFrame) -> Column:
    """All columns as one struct, so that names of working columns can not clash with them."""
    return F.struct(*[df[c] for c in df.columns]).alias("row")


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The packed columns again, some with a changed value."""
    return df.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in columns])
