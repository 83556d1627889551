"""Line-first quality rules.

Every line with a word is judged first (symbols, shouting, punctuation, navigation, boilerplate,
stutter); lines that fail are removed, and a document that would lose more than ``MAX_LOST`` percent
of its word characters is rejected, as is one that fails the base rules (too few words, or too many
words in repeated 8-word windows).

Defined cases: a null text has no words and fails the base rules; an empty line is never judged and
stays; repeated rows are judged alike. Rules see whole texts of any length; a window is compared
exactly, by numbers given to its word sequence (pairs, fours, eights), not by hash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from eavista.llm.common import packed, small_batches, unpacked, whole_text

#: Fixed values of the base rules.
MIN_WORDS, MAX_REPEAT, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
#: Percent of a document's word characters that may be removed with its failed lines.
MAX_LOST = 50
#: Line rules, in percent of the line's words or word characters.
MAX_SYMBOLS, MAX_SHOUTED, MAX_STUTTER = 10, 60, 30
#: Lines of at least so many words must hold some sentence punctuation.
PROSE_WORDS = 40
#: Phrases of site furniture, compared in lower case.
FURNITURE = (
    "accept all cookies", "all rights reserved", "click here", "cookie policy", "enable javascript",
    "log in", "privacy policy", "sign up", "skip to content", "subscribe to", "terms of use",
)
#: A line with furniture is removed when it has at most so many words.
FURNITURE_WORDS = 25

_SYMBOL = re.compile("[" + re.escape(SYMBOLS) + "]")
_EMPHASIS = re.compile("[!?]{2,}")
_UPPER, _LOWER = re.compile("[A-Z]"), re.compile("[a-z]")
_STOP = re.compile("[.!?:;]")
_BAR = re.compile(r"[|»]")
_FURNITURE = re.compile("|".join(FURNITURE))
_WORD = re.compile("[^ \t-\r]+")
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_failed_lines long, lost_chars long, clean_text string"
)


def repeated_words(words: list[str], size: int = WINDOW) -> int:
    """How many words lie in a window of ``size`` (a power of two) words found twice or more."""
    if len(words) <= size:
        return 0
    numbers: dict[str, int] = {}
    names = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    step = 1
    while step < size:
        paired = names[:-step] * len(words) + names[step:]
        _, names, counts = np.unique(paired, return_inverse=True, return_counts=True)
        step *= 2
    ends = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(counts[names] > 1)
    np.add.at(ends, starts, 1)
    np.add.at(ends, starts + size, -1)
    return int(np.count_nonzero(np.cumsum(ends)[: len(words)]))


def line_fails(line: str, words: list[str]) -> bool:
    """The line rules; ``words`` are the line's words, at least one."""
    n, chars = len(words), sum(map(len, words))
    upper = len(_UPPER.findall(line))
    if 100 * len(_SYMBOL.findall(line)) > MAX_SYMBOLS * chars:
        return True
    if n >= 4 and 100 * upper > MAX_SHOUTED * (upper + len(_LOWER.findall(line))):
        return True
    if 100 * len(_EMPHASIS.findall(line)) > MAX_STUTTER * n:
        return True
    if n >= PROSE_WORDS and not _STOP.search(line):
        return True
    bars = len(_BAR.findall(line))
    if bars >= 3 and 4 * bars >= n:
        return True
    if n >= 4 and 100 * sum(a == b for a, b in zip(words, words[1:])) > MAX_STUTTER * n:
        return True
    return n <= FURNITURE_WORDS and _FURNITURE.search(line.lower()) is not None


def judge_text(text: str) -> tuple:
    """One row of ``SCHEMA``."""
    n_words = word_chars = repeated_lines = n_lines = failed = lost = 0
    seen: set[str] = set()
    kept_lines, all_words = [], []
    for line in text.split("\n"):
        words = _WORD.findall(line)
        if not words:
            kept_lines.append(line)
            continue
        n_lines += 1
        n_words += len(words)
        chars = sum(map(len, words))
        word_chars += chars
        all_words += words
        if line in seen:
            repeated_lines += 1
        seen.add(line)
        if line_fails(line, words):
            failed += 1
            lost += chars
        else:
            kept_lines.append(line)
    repeats = repeated_words(all_words)
    base_failed = n_words < MIN_WORDS or 100 * repeats > MAX_REPEAT * n_words
    kept = not base_failed and 100 * lost <= MAX_LOST * word_chars
    symbols = len(_SYMBOL.findall(text))
    return (n_words, word_chars, symbols, repeated_lines, repeats, base_failed, kept,
            n_lines, failed, lost, "\n".join(kept_lines))


def judged(text: Column, with_text: bool = True) -> Column:
    """A struct of ``SCHEMA`` for every text; without ``with_text`` clean_text is null."""

    @F.pandas_udf(SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
        for texts in batches:
            rows = [judge_text(t) if with_text else (*judge_text(t)[:-1], None) for t in texts]
            yield pd.DataFrame(rows, columns=names)

    # Not to be moved or copied by the optimizer: a filter on a field of the result would run it a second time.
    return run.asNondeterministic()(text)


def quality(docs: DataFrame) -> DataFrame:
    """doc_id and the columns of ``SCHEMA`` but clean_text, for every row."""
    small_batches(docs.sparkSession)
    found = docs.select(docs["doc_id"].alias("doc_id"), judged(whole_text(docs), False).alias("q"))
    return found.select("doc_id", "q.*").drop("clean_text")


def clean(docs: DataFrame) -> DataFrame:
    """The documents that pass, with failed lines removed from ``text`` and all other columns unchanged."""
    small_batches(docs.sparkSession)
    marked = docs.select(packed(docs), judged(whole_text(docs)).alias("q")).filter("q.kept")
    return unpacked(marked, docs.columns, text=F.col("q.clean_text"))
