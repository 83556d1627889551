"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class is a normal distribution of ``FEATURES`` (log or square-root transformed shares, so that
their tails are short). Class covariances are shrunk towards the pooled one and towards its mean
variance; the score is the logistic of the difference of Mahalanobis log-densities plus the log
prior, computed with the inverses of the Cholesky factors, which are made once. Training is one
aggregation: counts, sums and products of the features by class, a row per class.

Defined cases: a null or empty text has features of an empty document and a score; a label other than
0 and 1, or null, is not learned from; repeated rows count as often as they stand; with a class
without rows the score is 0.5; other columns are ignored. Labels, lang, source and doc_id are never
features.
"""

from __future__ import annotations

import math
import operator
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eavista.llm.common import whole_text
from eavista.session import stage

#: Shrinkage of a class covariance towards the pooled one, and of that towards its mean variance.
TO_POOLED, TO_ROUND = 0.1, 0.02
FEATURES = (
    "words", "word_length", "long_words", "capitals", "digits", "symbols", "emphasis", "distinct", "stutter", "stops",
    "line_words",
)
_LIMIT = 30.0
_SYMBOL = re.compile(r"[#*$%&|<>=_~^{}\[\]\\@]")
_CAPITAL, _DIGIT, _EMPHASIS, _STOP = re.compile("[A-ZÀ-ÖØ-Þ]"), re.compile("[0-9]"), re.compile("[!?]"), re.compile("[.,;:]")


def features(text: str) -> list[float]:
    """Transformed statistics of a whole text, in the order of ``FEATURES``."""
    words = text.split()
    n, chars = len(words), sum(map(len, words))
    share = lambda count, of: math.sqrt(count / of) if of else 0.0
    return [
        math.log1p(n),
        math.log1p(chars / n) if n else 0.0,
        share(sum(len(w) > 12 for w in words), n),
        share(len(_CAPITAL.findall(text)), chars),
        share(len(_DIGIT.findall(text)), chars),
        share(len(_SYMBOL.findall(text)), chars),
        share(len(_EMPHASIS.findall(text)), n),
        math.log1p(len(set(words))) - math.log1p(n),
        share(sum(map(operator.eq, words, words[1:])), n),
        share(len(_STOP.findall(text)), n),
        math.log1p(n / (text.count("\n") + 1)),
    ]


def features_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(features)

    return run(text)


class Model(NamedTuple):
    """For each class: log prior minus half the log determinant, mean, inverse Cholesky factor."""

    offsets: tuple[float, float]
    means: np.ndarray
    inverses: np.ndarray


def fit(labelled: DataFrame) -> Model | None:
    """A model from columns f (features) and label (0 or 1); None if a class has no rows."""
    d = len(FEATURES)
    at = lambda i: F.element_at("f", i + 1)
    sums = [F.sum(at(i)) for i in range(d)] + [F.sum(at(i) * at(j)) for i in range(d) for j in range(i + 1)]
    rows = labelled.filter("label IN (0, 1)").groupBy("label").agg(F.count("*"), *sums).collect()
    if len(rows) < 2:
        return None
    counts, means, scatters = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for row in rows:
        k, n = row[0], row[1]
        counts[k], means[k] = n, np.array(row[2 : 2 + d]) / n
        lower = np.zeros((d, d))
        lower[np.tril_indices(d)] = row[2 + d :]
        products = lower + np.tril(lower, -1).T
        scatters[k] = products - n * np.outer(means[k], means[k])
    pooled = scatters.sum(axis=0) / counts.sum()
    offsets, inverses = [], []
    for k in range(2):
        shrunk = (1 - TO_POOLED) * scatters[k] / counts[k] + TO_POOLED * pooled
        shrunk = (1 - TO_ROUND) * shrunk + (TO_ROUND * np.trace(shrunk) / d + 1e-9) * np.eye(d)
        factor = np.linalg.cholesky(shrunk)
        offsets.append(float(np.log(counts[k] / counts.sum()) - np.log(np.diag(factor)).sum()))
        inverses.append(np.linalg.inv(factor))
    return Model(tuple(offsets), means, np.array(inverses))


def log_odds(model: Model, rows: np.ndarray) -> np.ndarray:
    """Log odds of class 1 for each row of features."""
    density = [
        model.offsets[k] - 0.5 * (((rows - model.means[k]) @ model.inverses[k].T) ** 2).sum(axis=1) for k in range(2)
    ]
    return density[1] - density[0]


def scorer(spark: SparkSession, model: Model | None):
    """A column function from features to the score of class 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if shared.value is None or not len(batch):
                yield pd.Series(np.full(len(batch), 0.5))
            else:
                odds = log_odds(shared.value, np.stack(batch.to_numpy()))
                yield pd.Series(1 / (1 + np.exp(-np.clip(odds, -_LIMIT, _LIMIT))))

    return score


def held_out(doc_id: Column) -> Column:
    """Is the row kept from training? A null doc_id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted for every row, learned from ``labels`` that are not held out."""
    marked = stage(
        docs.select(docs["doc_id"].alias("doc_id"), features_column(whole_text(docs)).alias("f")), "features"
    )
    known = labels.select(labels["doc_id"].alias("doc_id"), labels[label].cast("int").alias("label"))
    model = fit(marked.join(known, "doc_id").filter(~held_out(F.col("doc_id"))))
    scored = marked.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), scorer(docs.sparkSession, model)(F.col("f")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
