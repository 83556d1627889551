"""Cross-site boilerplate lines, found by the spread of a line over distinct sites (DataFrame functions only).

A line is known by two 64-bit hashes of its trimmed text. One aggregation merges a HyperLogLog
sketch of the sites for every line hash. A line whose estimate is well above ``SITES`` is
boilerplate, one well below is not, and for those near the threshold distinct sites are
counted exactly. Boilerplate lines are removed from every document, but for whole copies: a text that
stands under several doc_ids and consists of such lines for more than ``MOST`` percent of its characters
is a copied page, whose lines are spread because the page is. Document deduplication handles those.

Defined cases: a null text counts as empty; a null site is no site; a line of one word is never judged,
since short headings repeat by chance, unless it has ``UNSPACED_LETTERS`` letters of scripts that put no
spaces between words; lines compare after trimming ASCII spaces; repeated rows are cleaned alike and
are one document; a text of boilerplate alone becomes empty; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eavista.llm.common import let, packed, sha256, unpacked, whole_text
from eavista.session import stage

#: Distinct sites from which a line is boilerplate.
SITES = 5
#: Sketches of 2 ** 10 registers have a standard error of about 3 percent; the band is ten times that.
SKETCH_BITS, BAND = 10, 0.3
MOST = 50
_SPACES = " \t\n\v\f\r"
#: Fixed ranges of code points: Thai and Lao, Burmese, Khmer, kana, Han.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))
UNSPACED_PATTERN = "[" + "".join(f"\\x{{{first:X}}}-\\x{{{last:X}}}" for first, last in UNSPACED) + "]"
UNSPACED_LETTERS = 6


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(_SPACES))


def line_key(line: Column) -> Column:
    """128 bits of the trimmed line; null for a line of one word (see the cases above)."""
    text = trimmed(line)
    key = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("line"), text).alias("b"))
    unspaced = F.regexp_count(text, F.lit(UNSPACED_PATTERN)) >= UNSPACED_LETTERS
    return F.when(text.rlike(r"[ \t-\r]"), key).when(unspaced, key)


def _lines(docs: DataFrame, *kept: Column) -> DataFrame:
    """One row for every judged line: its key, its place in the text, its length, and ``kept`` columns."""
    found = docs.select(*kept, F.posexplode(F.split(whole_text(docs), "\n")).alias("place", "line"))
    found = found.withColumn("key", line_key(F.col("line"))).withColumn("chars", F.char_length("line")).drop("line")
    return found.filter("key IS NOT NULL").select("*", "key.a", "key.b").drop("key")


def boilerplate(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """a, b: keys of the lines that stand on at least ``sites`` distinct sites."""
    seen = _lines(docs, docs[site].cast("string").alias("site")).filter("site IS NOT NULL").select("a", "b", "site")
    sketches = seen.groupBy("a", "b").agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"))
    spread = sketches.select("a", "b", F.hll_sketch_estimate("sketch").alias("spread"))
    spread = stage(spread.filter(F.col("spread") >= (1 - BAND) * sites), "spread")
    clear = spread.filter(F.col("spread") >= (1 + BAND) * sites).select("a", "b")
    near = spread.filter(F.col("spread") < (1 + BAND) * sites).select("a", "b")
    exact = (
        seen.join(near, ["a", "b"], "left_semi").distinct()
        .groupBy("a", "b").agg(F.count("*").alias("n")).filter(F.col("n") >= sites).select("a", "b")
    )
    return stage(clear.unionByName(exact), "boilerplate")


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("text_a"), F.xxhash64(F.lit("text"), text).alias("text_b")]


def _found(docs: DataFrame, site: str, sites: int) -> DataFrame:
    """found_id, found_a, found_b, found_places (ascending): one row for every (doc_id, text) to be cleaned."""
    text = whole_text(docs)
    row = [docs["doc_id"].alias("found_id"), *_text_key(text), F.char_length(text).alias("length")]
    hits = (
        _lines(docs, *row).join(boilerplate(docs, site, sites), ["a", "b"], "left_semi")
        .groupBy("found_id", "text_a", "text_b", "length")
        .agg(F.array_sort(F.collect_set(F.struct("place", "chars"))).alias("hits"))
    )
    lost = F.aggregate("hits", F.lit(0), lambda total, hit: total + hit["chars"])
    hits = stage(hits.select(
        "found_id", "text_a", "text_b", F.transform("hits", lambda hit: hit["place"]).alias("found_places"),
        (100 * lost > MOST * F.col("length")).alias("most"),
    ), "hits")
    most = hits.filter("most")
    copies = most.groupBy("text_a", "text_b").agg(F.count("*").alias("n")).filter("n > 1")
    due = hits.filter("NOT most").unionByName(most.join(copies, ["text_a", "text_b"], "left_anti"))
    return due.select("found_id", F.col("text_a").alias("found_a"), F.col("text_b").alias("found_b"), "found_places")


def _without(lines: Column, places: Column) -> Column:
    """The lines at other places: the slices between the ascending ``places``."""
    def between(lines: Column, bounds: Column) -> Column:
        after, until = F.slice(bounds, F.lit(1), F.size(bounds) - 1), F.slice(bounds, F.lit(2), F.size(bounds) - 1)
        return F.flatten(F.zip_with(after, until, lambda low, high: F.slice(lines, low + 2, high - low - 1)))

    return let(lines, lambda some: let(
        F.concat(F.array(F.lit(-1)), places, F.array(F.size(some))), lambda bounds: between(some, bounds)
    ))


def _cleaned(docs: DataFrame, site: str, sites: int) -> DataFrame:
    """doc_id, row (the packed columns), text, n_removed and clean (the text that stays) for every row."""
    rows = docs.select(packed(docs), docs["doc_id"].alias("doc_id"), *_text_key(whole_text(docs)))
    same = [F.col("text_a") == F.col("found_a"), F.col("text_b") == F.col("found_b")]
    joined = rows.join(_found(docs, site, sites), F.col("doc_id").eqNullSafe(F.col("found_id")) & same[0] & same[1], "left")
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    kept = F.array_join(_without(F.split(text, "\n"), F.col("found_places")), "\n")
    return joined.select(
        "doc_id", "row", text.alias("text"),
        F.coalesce(F.size("found_places"), F.lit(0)).alias("n_removed"),
        F.when(F.col("found_places").isNull(), text).otherwise(kept).alias("clean"),
    )


def deduplicated(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 for every row."""
    return _cleaned(docs.select("doc_id", "text", site), site, sites).select(
        "doc_id",
        (F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.col("n_removed").cast("long").alias("n_removed"),
        sha256(F.col("clean")).alias("kept_sha256"),
    )


def remove_boilerplate(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """The documents with boilerplate lines removed from ``text``, all other columns unchanged."""
    cleaned = _cleaned(docs, site, sites)
    text = F.when((F.col("n_removed") == 0) & F.col("row.text").isNull(), F.lit(None)).otherwise(F.col("clean"))
    return unpacked(cleaned, docs.columns, text=text)
