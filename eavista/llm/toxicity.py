"""Toxicity: a noisy-channel decoder undoes leetspeak, spacing and repetition, then the restored text is scored.

1. A character trigram model is counted over all documents (Latin letters without accents, digits, other
   letters, and one symbol for what stands between words).
2. A suspicious span is a word with look-alike characters or letters repeated three times and more, or single
   characters in a row with one separator between them. Its lattice has, for every run of a character, the
   readings that the channel allows: itself, a letter it looks like, fewer repetitions, nothing. Viterbi's
   algorithm picks the cheapest path under the channel's costs and the language model.
3. Words of the restored text and their beginnings (``PREFIXES``) get log odds from labelled documents. Each
   word tells its feature with the largest weight; a document's log odds are the prior and the weights
   of the features told, each once; the score is a logistic curve of it, fitted to the same documents.
4. Words learned as toxic are mixed into the language model before the final scoring, so that their
   disguises are read as these words rather than as others.

The classifier is fitted on at most ``MOST_LABELS`` labelled rows (those with the smallest hashes of doc_id);
only features whose likelihood ratio is beyond ``SURE`` keep a weight, and at most ``MOST_FEATURES`` of
them. Character counts cover the whole table; the driver gets at most one row a trigram.

Defined cases: a null or empty text scores as a text without words; labels other than 0 and 1 or null are
not learned from; repeated rows are scored alike; rows with a null doc_id are scored but teach nothing;
without documents of both classes every score is 0.5; an empty table gives no rows; other columns
are ignored. Labels, lang, source and doc_id are never inputs of a score. Time is linear in the text.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from eavista.llm.common import whole_text

MOST_LABELS, MOST_FEATURES, SURE = 20_000, 50_000, 25.0
PREFIXES = (3, 5, 7)

#: Symbols of the language model: between words, a to z, digit, other letter.
GAP, DIGIT, OTHER, SYMBOLS = 0, 27, 28, 29
_KNOWN = 0x250

#: Letters that a character is used for in place of them.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou",
}
#: Costs of the channel, in natural logarithms.
LOOK_COST, MASK_COST, REPEAT_COST, DROP_COST, JOIN_COST = 1.0, 2.0, 0.7, 2.5, 0.3
_DIGIT_COST = math.log(10)
#: Share of learned words in the language model, and weight of the shorter context in an estimate.
LEARNED_SHARE, BACK_OFF = 0.5, 4.0
#: Paths kept at each place of a lattice: one a pair of last symbols, the cheapest ones.
BEAM = 24

_SPACED = re.compile(r"(?<!\w)[\w@$!|+](?:([ ._*-])[\w@$!|+])(?:\1[\w@$!|+])+(?!\w)")
_EDGE = ".,;:!?\"'()[]{}<>#%&*~^=|/\\-_"
_DECORATED = re.compile(r"^([$@+])\1\1+|([$@+])\2\2+$")
_SUSPICIOUS = re.compile(r"[^\W\d_].*[0-9@$!|+(*]|[0-9@$|+(*].*[^\W\d_]|([^\W\d_])\1\1", re.S)
_WORD = re.compile(r"[^\W\d_]+")
_LIMIT, _MEMO = 30.0, 200_000


def _symbol(char: str) -> int:
    base = unicodedata.normalize("NFKD", char)[:1].lower() if char != "ß" else "s"
    if "a" <= base <= "z":
        return ord(base) - 96
    return DIGIT if char.isdecimal() else OTHER if char.isalpha() else GAP


#: The symbol of every code point below ``_KNOWN``; all others count as other letters.
_TABLE = np.array([_symbol(chr(i)) for i in range(_KNOWN)] + [OTHER], np.int32)


def symbols(text: str) -> np.ndarray:
    return _TABLE[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), _KNOWN)]


def _counts(texts: Iterable[str], slice_of: int = 1 << 20) -> np.ndarray:
    """Trigram counts of texts, each with gaps around it; long ones in slices that overlap by two."""
    total = np.zeros(SYMBOLS**3, np.int64)
    for text in texts:
        for at in range(0, len(text) + 1, slice_of):
            part = symbols(text[max(at - 2, 0) : at + slice_of])
            lead = [GAP] * max(2 - at, 0)
            tail = [GAP] if at + slice_of > len(text) else []
            row = np.concatenate([np.array(lead, np.int32), part, np.array(tail, np.int32)])
            total += np.bincount(row[:-2] * SYMBOLS**2 + row[1:-1] * SYMBOLS + row[2:], minlength=SYMBOLS**3)
    return total


def character_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts over all texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            total += _counts(batch["text"])
        found = np.flatnonzero(total)
        yield pd.DataFrame({"trigram": found, "n": total[found]})

    rows = docs.select(whole_text(docs).alias("text")).mapInPandas(count, "trigram int, n long")
    total = np.zeros(SYMBOLS**3)
    for row in rows.groupBy("trigram").agg(F.sum("n").alias("n")).collect():
        total[row.trigram] = row.n
    return total


def _estimate(counts: np.ndarray, back_off: float) -> np.ndarray:
    """P(c | a, b), each context smoothed by the one that is a symbol shorter."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (two + back_off * p1) / (two.sum(axis=1, keepdims=True) + back_off)
    return (three + back_off * p2) / (three.sum(axis=2, keepdims=True) + back_off)


def language_costs(counts: np.ndarray, learned: Iterable[str] = ()) -> list[float]:
    """-log P(c | a, b) as a flat list, with learned words mixed in."""
    p = _estimate(counts, BACK_OFF)
    words = list(learned)
    if words:
        p = (1 - LEARNED_SHARE) * p + LEARNED_SHARE * _estimate(_counts(words).astype(float), 0.1)
    return (-np.log(p)).ravel().tolist()


def _readings(char: str, n: int, separator: str | None) -> list[tuple[str, tuple[int, ...], float]]:
    """What a run of a character may stand for: text, symbols, cost of the channel."""
    own = int(symbols(char)[0])
    if char == separator:
        return [("", (), n * JOIN_COST), (char * n, (GAP,), 0.0)]
    found = [(char * n, (GAP,) if own == GAP else (own,) * n, n * _DIGIT_COST if own == DIGIT else 0.0)]
    if own not in (GAP, DIGIT) and n > 1:
        found += [(char * k, (own,) * k, REPEAT_COST) for k in (1, 2) if k < n]
    cost = MASK_COST if char == "*" else LOOK_COST
    for letter in LOOKS.get(char, ""):
        symbol = ord(letter) - 96
        found.append((letter, (symbol,), cost + (REPEAT_COST if n > 1 else 0)))
        if n == 2:
            found.append((letter * 2, (symbol,) * 2, 2 * cost))
    if own == GAP:
        found.append(("", (), DROP_COST))
    return found


def decode(span: str, costs: list[float], separator: str | None = None) -> str:
    """The cheapest reading of a span."""
    paths = {(GAP, GAP): (0.0, None)}
    for char, run in groupby(span):
        readings = _readings(char, sum(1 for _ in run), separator)
        after = {}
        for (a, b), (cost, trail) in paths.items():
            for text, emitted, price in readings:
                x, y, total = a, b, cost + price
                for symbol in emitted:
                    if symbol == GAP == y:
                        continue
                    total += costs[(x * SYMBOLS + y) * SYMBOLS + symbol]
                    x, y = y, symbol
                if (x, y) not in after or total < after[x, y][0]:
                    after[x, y] = (total, (trail, text))
        paths = after if len(after) <= BEAM else dict(sorted(after.items(), key=lambda p: p[1][0])[:BEAM])
    ends = (
        (total + (0 if y == GAP else costs[(x * SYMBOLS + y) * SYMBOLS + GAP]), i)
        for i, ((x, y), (total, _)) in enumerate(paths.items())
    )
    trail, parts = list(paths.values())[min(ends)[1]][1], []
    while trail:
        trail, text = trail
        parts.append(text)
    return "".join(reversed(parts))


class Restorer:
    """Restores texts under one language model, each distinct word once."""

    def __init__(self, costs: list[float]):
        self.costs, self.memo = costs, {}

    def _spaced(self, match: re.Match) -> str:
        return decode(match[0].lower(), self.costs, match[1])

    def word(self, token: str) -> str:
        """A token in lower case, decoded if it is suspicious; decoration at its ends goes."""
        known = self.memo.get(token)
        if known is None:
            known = core = token.lower()
            if not core.isalpha() or len(core) > 2:
                core = _DECORATED.sub("", core.strip(_EDGE))
                known = decode(core, self.costs) if _SUSPICIOUS.search(core) else core
            if len(self.memo) >= _MEMO:
                self.memo.clear()
            self.memo[token] = known
        return known

    def text(self, text: str) -> str:
        """The whole restored text, words separated by single spaces."""
        return " ".join(map(self.word, _SPACED.sub(self._spaced, text).split()))

    def words(self, text: str) -> set[str]:
        """The distinct words of the restored text."""
        tokens = set(_SPACED.sub(self._spaced, text).split())
        return set(_WORD.findall(" ".join(map(self.word, tokens))))


def _features(word: str) -> list[str]:
    return [word] + [word[:n] + "~" for n in PREFIXES if n <= len(word)]


class Model(NamedTuple):
    """Log odds of the classes, weights of features, costs of the language model, and the scale of the score."""

    prior: float
    weights: dict[str, float]
    costs: list[float]
    shift: float = 0.0
    slope: float = 1.0


def held_out(doc_id: Column) -> Column:
    """Is the row kept from training? A null doc_id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _feature_counts(marked: DataFrame, costs: list[float]) -> DataFrame:
    """Documents of each class by feature of their restored text."""
    shared = marked.sparkSession.sparkContext.broadcast(costs)

    @F.pandas_udf("array<string>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restorer = Restorer(shared.value)
        for texts in batches:
            yield pd.Series([list({f for w in restorer.words(t) for f in _features(w)}) for t in texts])

    told = marked.select("label", F.explode(features("text")).alias("feature"))
    return told.groupBy("feature").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model | None:
    """The model of labelled documents that are not held out; None if a class has no documents."""
    known = labels.select(labels["doc_id"].alias("doc_id"), labels[label].cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "label").limit(MOST_LABELS)
    texts = docs.select(docs["doc_id"].alias("doc_id"), whole_text(docs).alias("text"))
    # The chosen rows are at most MOST_LABELS pairs of numbers.
    marked = texts.join(F.broadcast(chosen), "doc_id").select("label", "text")
    sizes = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    counts = character_counts(docs)
    plain = language_costs(counts)
    toxic, clean = F.col("toxic"), F.col("clean")
    found = _feature_counts(marked, plain).select(
        "feature", "toxic", "clean",
        (F.log((toxic + 0.5) / (sizes[1] + 1)) - F.log((clean + 0.5) / (sizes[0] + 1))).alias("weight"),
        _likelihood_ratio(toxic, clean, sizes[1], sizes[0]).alias("sure"),
    ).filter(F.col("sure") >= SURE).orderBy(F.desc("sure"), "feature").limit(MOST_FEATURES).collect()
    weights = {r.feature: r.weight for r in found}
    learned = [w for w, weight in weights.items() if weight > 2 and len(w) > 3 and not w.endswith("~")]
    model = Model(math.log(sizes[1] / sizes[0]), weights, language_costs(counts, learned))
    shift, slope = _calibration(marked, model)
    return model._replace(shift=shift, slope=slope)


def _odds_column(texts: DataFrame, model: Model | None) -> Column:
    shared = texts.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def tell(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        restorer = Restorer(model.costs) if model else None
        for batch in batches:
            yield pd.Series([odds(model, restorer.words(t)) if model else 0.0 for t in batch], dtype=float)

    return tell(whole_text(texts))


def _calibration(marked: DataFrame, model: Model) -> tuple[float, float]:
    """Shift and slope of the logistic curve through the labelled documents' log odds (in tenths)."""
    tenths = F.round(F.least(F.greatest(_odds_column(marked, model), F.lit(-_LIMIT)), F.lit(_LIMIT)) * 10)
    rows = marked.select("label", tenths.alias("x")).groupBy("label", "x").count().collect()
    x, y, n = (np.array([r[i] for r in rows], float) for i in (1, 0, 2))
    terms = np.stack([np.ones(len(x)), x / 10])
    fitted = np.array([0.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(fitted @ terms, -_LIMIT, _LIMIT)))
        # A weak pull towards the plain log odds keeps separable classes finite.
        pull = 0.1 * (fitted - [0.0, 1.0])
        step = np.linalg.solve((terms * n * p * (1 - p)) @ terms.T + 0.1 * np.eye(2), terms @ (n * (y - p)) - pull)
        fitted = fitted + np.clip(step, -1, 1)
    return float(fitted[0]), float(fitted[1])


def _likelihood_ratio(a: Column, b: Column, with_a: int, with_b: int) -> Column:
    """Twice the log-likelihood ratio of a word's counts in two classes against one common share."""
    share = (a + b) / F.lit(with_a + with_b)

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    return 2 * (
        term(a, share * with_a) + term(b, share * with_b)
        + term(with_a - a, (1 - share) * with_a) + term(with_b - b, (1 - share) * with_b)
    )


def odds(model: Model, words: Iterable[str]) -> float:
    """Log odds of a document with these distinct words."""
    weights, told = model.weights, set()
    for word in words:
        own = [f for f in _features(word) if f in weights]
        if own:
            told.add(max(own, key=lambda f: (abs(weights[f]), f)))
    return model.prior + sum(weights[f] for f in sorted(told))


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted for every row, learned from ``labels`` that are not held out."""
    model = fit(docs, labels, label)
    told = _odds_column(docs, model)
    if model:
        told = F.lit(model.shift) + F.lit(model.slope) * told
    bounded = F.least(F.greatest(told, F.lit(-_LIMIT)), F.lit(_LIMIT))
    scored = docs.select(
        docs["doc_id"].alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), (1 / (1 + F.exp(-bounded))).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def restored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the whole restored text of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model.costs)

    @F.pandas_udf("string")
    def restore(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restorer = Restorer(shared.value)
        for texts in batches:
            yield texts.map(restorer.text)

    return docs.select(docs["doc_id"].alias("doc_id"), restore(whole_text(docs)).alias("restored"))
