"""Removal of long repeated word sequences across documents, by recompression.

A window of ``WINDOW`` words is removed where the same words also start a window in a document with a
smaller doc_id. Comparing all windows would move a row for every word, so:

1. One pass parses every document (``recompression``) and writes, a row a document, the hashes of its
   word sequence, its anchors (about one for 13 words) and the names of its *direct* windows, those
   in which no anchor is decided, such as long repetitions.
2. Anchors are grouped; one that stands in two different word sequences is shared. Documents with
   the same whole sequence need no windows: all but the first are removed as a whole.
3. If a window repeats elsewhere, all anchors decided inside it are shared. Only documents with shared
   anchors are parsed again, and only windows of this kind are named (128 bits), joined by the direct ones.
4. Window names are grouped with their smallest doc_id, combined before the shuffle, and joined back.
   Covered words are dropped from the texts.

Steps 3 and 4 send only texts to the shuffle that pass a Bloom filter of fixed size over the doc_ids
in question; joins behind it are exact.

Defined cases: a null text has no words; a row without doc_id is left as it is and is no source; rows that
repeat a doc_id are parts of one document and never remove each other's words; other columns are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from eavista.llm import bloom
from eavista.llm.common import packed, small_batches, unpacked, whole_text
from eavista.llm.recompression import Anchors, anchors, window_names, word_names
from eavista.session import stage

WINDOW = 50
#: Words parsed at a time; a longer document is parsed alone.
BATCH_WORDS = 200_000
BLOCK_BITS = 16
#: In a list of window starts: the whole document.
WHOLE = -1
PARSED = (
    "key_a long, key_b long, n_words int, anchors array<long>, "
    "direct_place array<int>, direct_a array<long>, direct_b array<long>"
)
WINDOWS = "doc_id long, text_key long, place int, a long, b long"
RESULT = "n_words long, n_removed long, kept_sha256 string, kept_text string"


class _Batch:
    """Documents laid end to end."""

    def __init__(self, documents: list[list[bytes]], size: int):
        self.lengths = np.array([len(words) for words in documents], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.names = word_names([word for words in documents for word in words])
        self.doc = np.repeat(np.arange(len(documents)), self.lengths)
        self.place = np.arange(len(self.names)) - self.starts[self.doc]
        self.size = size
        #: Is a window of ``size`` words starting here?
        self.whole = self.place + size <= self.lengths[self.doc]

    def anchors(self) -> Anchors:
        return anchors(self.names, self.doc, self.place)

    def counts(self, found: Anchors, chosen: np.ndarray) -> np.ndarray:
        """How many of the chosen anchors are decided inside the window that starts at each word."""
        first = np.maximum(found.high - self.size, 0)
        last = np.minimum(found.low, self.lengths[found.doc] - self.size)
        use = chosen & (last >= first)
        begin = self.starts[found.doc[use]]
        length = len(self.names) + 1
        steps = np.bincount(begin + first[use], minlength=length) - np.bincount(begin + last[use] + 1, minlength=length)
        return np.cumsum(steps)[: len(self.names)]

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both names of the windows that start at these words."""
        if not len(at):
            none = np.zeros(0, np.int64)
            return none, none
        return tuple(window_names(self.names, self.size, salt)[at].view(np.int64) for salt in (11, 23))


def _batches(texts) -> Iterator[tuple[slice, list[list[bytes]]]]:
    start, held, words = 0, [], 0
    for number, text in enumerate(texts):
        held.append(text.encode("utf-8", "surrogatepass").split())
        words += len(held[-1])
        if words >= BATCH_WORDS:
            yield slice(start, number + 1), held
            start, held, words = number + 1, [], 0
    if held:
        yield slice(start, start + len(held)), held


def _parsed(documents: list[list[bytes]], size: int) -> pd.DataFrame:
    batch = _Batch(documents, size)
    found = batch.anchors()
    direct = np.flatnonzero(batch.whole & (batch.counts(found, np.ones(len(found.name), bool)) == 0))
    a, b = batch.windows(direct)
    at_anchor = np.searchsorted(found.doc, np.arange(len(documents) + 1))
    at_window = np.searchsorted(batch.doc[direct], np.arange(len(documents) + 1))
    signed, place = found.name.view(np.int64), batch.place[direct].astype(np.int32)
    rows = []
    for i, words in enumerate(documents):
        whole = xxhash.xxh3_128_digest(b" ".join(words))
        key_a, key_b = np.frombuffer(whole, np.int64).tolist()
        of, windows = slice(at_anchor[i], at_anchor[i + 1]), slice(at_window[i], at_window[i + 1])
        rows.append((key_a, key_b, len(words), np.unique(signed[of]), place[windows], a[windows], b[windows]))
    return pd.DataFrame(rows, columns=[field.split(" ")[0] for field in PARSED.split(", ")])


def _parser(size: int):
    @F.pandas_udf(PARSED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = [_parsed(documents, size) for _, documents in _batches(texts)]
            if parts:
                yield pd.concat(parts, ignore_index=True)
            else:
                yield _parsed([], size)

    return run


def _windows_of(rows: DataFrame, size: int) -> DataFrame:
    """Windows with at least one anchor decided inside them, all of those shared."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, documents in _batches(frame["text"]):
                rows = frame.iloc[part]
                batch = _Batch(documents, size)
                found = batch.anchors()
                sizes = np.array([len(s) for s in rows["shared"]], np.int64)
                known = np.concatenate([np.asarray(s, np.int64) for s in rows["shared"]]).view(np.uint64)
                owner = np.repeat(np.arange(len(documents)), sizes).astype(np.uint64)
                # A shared anchor's name with its document's number, as one number.
                step = np.uint64(0xD6E8FEB86659FD93)
                shared = np.isin(found.name + found.doc.astype(np.uint64) * step, known + owner * step)
                everything = batch.counts(found, np.ones(len(found.name), bool))
                at = np.flatnonzero(batch.whole & (everything > 0) & (everything == batch.counts(found, shared)))
                a, b = batch.windows(at)
                yield pd.DataFrame({
                    "doc_id": rows["doc_id"].to_numpy()[batch.doc[at]],
                    "text_key": rows["text_key"].to_numpy()[batch.doc[at]],
                    "place": batch.place[at].astype(np.int32), "a": a, "b": b,
                })

    return rows.mapInPandas(run, WINDOWS)


def _texts(docs: DataFrame) -> DataFrame:
    text = whole_text(docs)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def repeated_windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, text_key, starts: where windows to be removed start; ``WHOLE`` for the whole document."""
    spark, texts = docs.sparkSession, _texts(docs)
    small_batches(spark)
    parsed = stage(texts.select("doc_id", "text_key", _parser(size)(F.col("text")).alias("p")).select("doc_id", "text_key", "p.*"), "parsed")
    known = parsed.filter((F.col("n_words") >= size) & F.col("doc_id").isNotNull())

    firsts = known.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    copied = known.select("doc_id", "text_key", "key_a", "key_b").join(
        firsts.filter("first_id < last_id"), ["key_a", "key_b"]
    ).filter("doc_id > first_id").select("doc_id", "text_key")

    named = known.select("doc_id", "text_key", "key_a", F.explode("anchors").alias("name"))
    shared = (
        named.groupBy("name").agg(F.min("key_a").alias("low"), F.max("key_a").alias("high"))
        .filter("low < high").select("name")
    )
    lists = named.join(shared, "name", "left_semi").groupBy("doc_id", "text_key").agg(F.collect_set("name").alias("shared"))
    lists = stage(lists.join(copied.distinct(), ["doc_id", "text_key"], "left_anti"), "shared_anchors")

    maybe = bloom.tester(spark, bloom.build(lists, "doc_id", BLOCK_BITS))
    again = texts.filter(maybe(F.col("doc_id"))).join(lists, ["doc_id", "text_key"])
    direct = known.select(
        "doc_id", "text_key", F.explode(F.arrays_zip("direct_place", "direct_a", "direct_b")).alias("w")
    ).select("doc_id", "text_key", F.col("w.direct_place").alias("place"), F.col("w.direct_a").alias("a"),
             F.col("w.direct_b").alias("b"))
    windows = stage(_windows_of(again, size).unionByName(direct), "windows")

    sources = (
        windows.groupBy("a", "b").agg(F.min("doc_id").alias("source_id"), F.max("doc_id").alias("last_id"))
        .filter("source_id < last_id").select("a", "b", "source_id")
    )
    hits = windows.join(sources, ["a", "b"]).filter("doc_id > source_id").select("doc_id", "text_key", "place")
    hits = hits.unionByName(copied.withColumn("place", F.lit(WHOLE)))
    return stage(hits.groupBy("doc_id", "text_key").agg(F.collect_list("place").alias("starts")), "repeats")


def _keep(text: str, starts, size: int, with_text: bool) -> tuple:
    words = text.encode("utf-8", "surrogatepass").split()
    gone = np.zeros(len(words) + 1, np.int64)
    if starts is not None and len(starts):
        starts = np.asarray(starts, np.int64)
        if (starts == WHOLE).any():
            starts, size = np.zeros(1, np.int64), len(words)
        length = len(words) + 1
        gone += np.bincount(starts, minlength=length) - np.bincount(starts + size, minlength=length)
        gone = np.cumsum(gone)
    kept = [word for word, covered in zip(words, gone.tolist()) if not covered]
    joined = b" ".join(kept)
    digest = hashlib.sha256(joined).hexdigest()
    return len(words), len(words) - len(kept), digest, joined.decode("utf-8", "surrogatepass") if with_text else None


def _keeper(size: int, with_text: bool):
    @F.pandas_udf(RESULT)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts in batches:
            rows = [_keep(t, s, size, with_text) for t, s in zip(texts, starts)]
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "kept_text"])

    return run


def _cleaned(docs: DataFrame, size: int, with_text: bool) -> DataFrame:
    """doc_id, row (the packed columns) and kept (a struct of ``RESULT``) for every row."""
    spark = docs.sparkSession
    repeats = repeated_windows(docs, size).withColumnsRenamed({"doc_id": "found_id", "text_key": "found_key"})
    maybe = bloom.tester(spark, bloom.build(repeats, "found_id", BLOCK_BITS))
    key: Column = docs["doc_id"].cast("long")
    text = whole_text(docs)
    rows = docs.select(
        packed(docs), docs["doc_id"].alias("doc_id"), key.alias("id"), text.alias("text"),
        F.xxhash64(text).alias("text_key"), maybe(key).alias("maybe"),
    )
    same = (F.col("id") == F.col("found_id")) & (F.col("text_key") == F.col("found_key"))
    touched = rows.filter("maybe").join(repeats, same, "left").drop("found_id", "found_key")
    both = touched.unionByName(rows.filter("NOT maybe").withColumn("starts", F.lit(None).cast("array<int>")))
    return both.select("doc_id", "row", _keeper(size, with_text)(F.col("text"), F.col("starts")).alias("kept"))


def deduplicated(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row."""
    found = _cleaned(docs.select("doc_id", "text"), size, False)
    return found.select("doc_id", "kept.n_words", "kept.n_removed", "kept.kept_sha256")


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents with repeated windows removed from ``text`` (words joined by one space where any were)."""
    found = _cleaned(docs, size, True)
    text = F.when(F.col("kept.n_removed") > 0, F.col("kept.kept_text")).otherwise(F.col("row.text"))
    return unpacked(found, docs.columns, text=text)
