"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

A text is cut where its own content says so (the first sentence or line end after ``MIN_CHUNK``
characters). A chunk is known by a 128-bit identifier; one aggregation over the distinct chunks
proves that no identifier stands for two contents, and where one does, the chunk's content itself
becomes part of its identifier. A document is then its recipe, the ordered list of identifiers, and
only recipes are grouped and joined: a long text is moved once, as chunks combined before the
shuffle, and never as a whole.

Defined cases: a null text counts as empty; empty texts have the empty recipe and form one group;
of equal texts the row with the largest doc_id stays, a null doc_id only if all are null; rows that
repeat the same doc_id and text share the verdict of that doc_id. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eavista.llm.common import sha256, whole_text

MIN_CHUNK, MAX_CHUNK = 512, 4096
#: More identifiers with two contents than this mean a broken hash, not chance.
MAX_AMBIGUOUS = 1000


def chunks(text: Column) -> Column:
    """The text's consecutive chunks; together they are the text."""
    cut = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 1}}}?[.!?\n](?=\s)|.{{1,{MAX_CHUNK}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def chunk_id(chunk: Column) -> Column:
    return F.struct(F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit("second"), chunk).alias("b"))


def ambiguous_ids(docs: DataFrame, identify=chunk_id) -> list[tuple[int, int]]:
    """Identifiers that stand for more than one chunk content (none, but for a hash collision)."""
    found = (
        docs.select(F.explode(chunks(whole_text(docs))).alias("chunk"))
        .select(identify(F.col("chunk")).alias("id"), "chunk")
        .select("id.a", "id.b", "chunk")
        .groupBy("a", "b", "chunk").agg(F.lit(1).alias("one"))
        .groupBy("a", "b").agg(F.count("*").alias("contents"))
        .filter("contents > 1").select("a", "b").limit(MAX_AMBIGUOUS + 1).collect()
    )
    if len(found) > MAX_AMBIGUOUS:
        raise ValueError(f"more than {MAX_AMBIGUOUS} chunk identifiers stand for two contents")
    return [(row.a, row.b) for row in found]


def recipe(text: Column, ambiguous: list[tuple[int, int]], identify=chunk_id) -> Column:
    """Ordered verified identifiers: (a, b, content), content only for ambiguous identifiers."""
    unclear = [f"{a}:{b}" for a, b in ambiguous]

    def verified(chunk: Column) -> Column:
        found = identify(chunk)
        name = F.concat_ws(":", found["a"].cast("string"), found["b"].cast("string"))
        content = F.when(name.isin(unclear), chunk) if unclear else F.lit(None).cast("string")
        return F.struct(found["a"].alias("a"), found["b"].alias("b"), content.alias("content"))

    return F.transform(chunks(text), verified)


def exact_duplicates(docs: DataFrame, identify=chunk_id) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for every input row."""
    text = whole_text(docs)
    recipes = docs.select(
        docs["doc_id"].alias("doc_id"),
        recipe(text, ambiguous_ids(docs, identify), identify).alias("recipe"),
        sha256(text).alias("text_sha256"),
    )
    groups = (
        recipes.groupBy("recipe")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
        .withColumnRenamed("recipe", "group_recipe")
    )
    joined = recipes.join(groups, F.col("recipe") == F.col("group_recipe"), "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns. Repeated rows of one doc_id and text all stay."""
    kept = exact_duplicates(docs).filter("kept")
    kept = kept.select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha")).distinct()
    same = docs["doc_id"].eqNullSafe(kept["_kept_id"]) & (sha256(whole_text(docs)) == kept["_kept_sha"])
    return docs.join(kept, same, "left_semi")
