"""Every score of the quality classifier against a discriminant of plain loops."""

import math
import re
import zlib

from eavista.llm import quality_qda
from tests.compare import SF_DIR


def plain_features(text):
    words = text.split()
    n, chars = len(words), sum(len(w) for w in words)

    def root(count, of):
        return math.sqrt(count / of) if of else 0.0

    return [
        math.log(1 + n),
        math.log(1 + chars / n) if n else 0.0,
        root(len([w for w in words if len(w) > 12]), n),
        root(len([c for c in text if re.fullmatch("[A-ZÀ-ÖØ-Þ]", c)]), chars),
        root(len([c for c in text if c in "0123456789"]), chars),
        root(len([c for c in text if c in "#*$%&|<>=_~^{}[]\\@"]), chars),
        root(text.count("!") + text.count("?"), n),
        math.log(1 + len(set(words))) - math.log(1 + n),
        root(len([i for i in range(1, n) if words[i] == words[i - 1]]), n),
        root(len([c for c in text if c in ".,;:"]), n),
        math.log(1 + n / len(text.split("\n"))),
    ]


def solved(matrix, vector):
    """x of matrix x = vector, and the log determinant, by elimination with row exchanges."""
    d = len(vector)
    rows = [[*matrix[i], vector[i]] for i in range(d)]
    log_det = 0.0
    for i in range(d):
        best = max(range(i, d), key=lambda r: abs(rows[r][i]))
        rows[i], rows[best] = rows[best], rows[i]
        log_det += math.log(abs(rows[i][i]))
        for r in range(d):
            if r != i:
                factor = rows[r][i] / rows[i][i]
                rows[r] = [a - factor * b for a, b in zip(rows[r], rows[i])]
    return [rows[i][d] / rows[i][i] for i in range(d)], log_det


def plain_scores(texts, labels):
    d = 11
    features = {i: plain_features(t) for i, t in texts.items()}
    learned = {i: k for i, k in labels.items() if i in texts and k in (0, 1) and zlib.crc32(str(i).encode()) % 3 != 1}
    members = {k: [features[i] for i, own in learned.items() if own == k] for k in (0, 1)}
    mean = {k: [sum(f[a] for f in own) / len(own) for a in range(d)] for k, own in members.items()}
    scatter = {
        k: [[sum((f[a] - mean[k][a]) * (f[b] - mean[k][b]) for f in own) for b in range(d)] for a in range(d)]
        for k, own in members.items()
    }
    total = len(learned)
    shrunk = {}
    for k, own in members.items():
        toward = quality_qda.TO_POOLED
        part = [
            [(1 - toward) * scatter[k][a][b] / len(own) + toward * (scatter[0][a][b] + scatter[1][a][b]) / total for b in range(d)]
            for a in range(d)
        ]
        variance = sum(part[a][a] for a in range(d)) / d
        round_ = quality_qda.TO_ROUND
        shrunk[k] = [
            [(1 - round_) * part[a][b] + (round_ * variance + 1e-9 if a == b else 0.0) for b in range(d)] for a in range(d)
        ]

    def log_density(k, f):
        off = [f[a] - mean[k][a] for a in range(d)]
        x, log_det = solved(shrunk[k], off)
        return math.log(len(members[k]) / total) - 0.5 * (log_det + sum(a * b for a, b in zip(off, x)))

    odds = {i: log_density(1, f) - log_density(0, f) for i, f in features.items()}
    return {i: 1 / (1 + math.exp(-max(-30.0, min(30.0, o)))) for i, o in odds.items()}


def test_scores_equal_plain_loops(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    expected = plain_scores(texts, {r.doc_id: r.quality for r in labels.collect()})
    found = {r.doc_id: r.score for r in quality_qda.classify(docs, labels).collect()}
    assert found.keys() == expected.keys()
    assert max(abs(found[i] - expected[i]) for i in expected) < 1e-6
