"""Models of the secret scan: scores, threshold and spans against plain loops, recall and precision on planted strings."""

import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from eavista.llm import secret_scan
from tests.compare import SF_DIR
from tests.llm.conftest import PROSE

TEXT = "doc_id long, text string"


def codes(value):
    return [ord(c) - 43 for c, _ in itertools.groupby(value)]


def model_by_loops(labelled):
    """Log ratios by (now, then), from (value, label, kind)."""
    seen = {}
    for value, label, kind in labelled:
        c = codes(value)
        for pair in zip(c, c[1:]):
            if all(0 <= x < 80 for x in pair):
                seen.setdefault((label, kind), []).append(pair)
    counts = {}
    for (label, kind), pairs in seen.items():
        of_class = [len(p) for (c, _), p in seen.items() if c == label]
        for pair in pairs:
            counts[label, pair] = counts.get((label, pair), 0) + sum(of_class) / len(of_class) / len(pairs)

    def log(label, now, then):
        total = sum(n for (c, pair), n in counts.items() if c == label and pair[0] == now)
        learned = (counts.get((label, (now, then)), 0) + 0.5) / (total + 33)
        return math.log(0.9 * learned + 0.1 / 66)

    return lambda now, then: round(1000 * (log(1, now, then) - log(0, now, then)))


def test_scores_equal_plain_loops(spark):
    rng = random.Random(3)
    letters = "abcxyzABC019_-+/="
    labelled = [("".join(rng.choice(letters) for _ in range(rng.randint(0, 30))), rng.randint(0, 1), rng.randint(0, 3))
                for _ in range(120)]
    made = spark.createDataFrame([*labelled, (None, 1, 0), ("ignored", 2, 0)], "value string, label int, kind int")
    model, plain = secret_scan.train(made), model_by_loops(labelled)
    values = ["".join(rng.choice(letters) for _ in range(n)) for n in (0, 1, 2, 16, 40, 300)] + ["aaaaaa"]
    scored = spark.createDataFrame([(v,) for v in values], "value string").select(
        "value", secret_scan.ratio(F.col("value"), model).alias("score")).collect()
    for row in scored:
        c = codes(row.value)
        assert row.score == sum(plain(now, then) for now, then in zip(c, c[1:]))


def test_threshold_takes_few_held_out_identifiers(spark):
    model = [0] * (80 * 80)
    model[(ord("a") - 43) * 80 + ord("b") - 43] = 1000
    held = [(f"{'ab' * k}{'-_' * 8}", 0) for k in range(10) for _ in range(200)] + [("ab" * 30, 1)]
    made = spark.createDataFrame(held, "value string, label int")
    # 9,000 is reached by a tenth of them, which is too many
    assert secret_scan.threshold(made, model) == 9_100
    assert secret_scan.threshold(made.filter("length(value) < 16"), model) == secret_scan.MIN_RATIO
    assert secret_scan.threshold(made.filter("label = 1"), model) == secret_scan.MIN_RATIO


def test_words_are_those_outside_base_spans(spark):
    rows = [(1, "password=horsebattery2 snake_case_name camelCaseName HTTPServer x9 don't"), (2, None), (3, "")]
    found = {r.word for r in secret_scan.words(spark.createDataFrame(rows, TEXT)).collect()}
    assert found == {"snake", "case", "name", "camel", "http", "server", "don"}


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labelled = secret_scan.samples(docs, secret_scan.located(docs))
    found = secret_scan.train(labelled.filter("NOT held"))
    return found, secret_scan.threshold(labelled.filter("held"), found)


IDENTIFIERS = (
    "connection_pool_manager getUserProfileSettings MAX_CONNECTION_COUNT application/json/utf8 some-kebab-case-name "
    "2024-05-17T12-00-00 https/example/org/path xxxxxxxxxxxxxxxxxxxxxx user_id_000123456789 Donaudampfschifffahrt "
    "internationalization abcdefghijklmnopqrstuvwxyz utm_source=newsletter IMG_20240517_120000 org-apache-spark-sql "
    "HTTPSConnectionPoolError user_profile_settings applicationServerName"
).split()


def taken(spark, model, values):
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    return [r.value for r in rows.filter(secret_scan.ratio(F.col("value"), model[0]) >= model[1]).collect()]


@pytest.mark.parametrize("alphabet", [0, 1, 3, 5])
def test_random_strings_are_found(spark, model, alphabet):
    """Letters and digits, base64, upper case and digits, upper-case hex: strings no sample holds."""
    rng = random.Random(alphabet)
    values = ["".join(rng.choice(secret_scan.ALPHABETS[alphabet]) for _ in range(n)) for n in (20, 24, 40) for _ in range(200)]
    assert len(taken(spark, model, values)) >= 0.95 * len(values)


def test_ordinary_identifiers_are_left_alone(spark, model):
    assert taken(spark, model, IDENTIFIERS) == []


def test_spans_equal_plain_loops(spark):
    """Model spans of a small corpus: candidates that touch no base span and score the threshold."""
    rng = random.Random(9)
    draw = lambda n: "".join(rng.choice(secret_scan.ALPHABETS[0]) for _ in range(n))
    rows = [(i, f"{PROSE} {draw(rng.randint(12, 40))} é {IDENTIFIERS[i % len(IDENTIFIERS)]} token={draw(20)} {draw(24)}") for i in range(40)]
    docs = spark.createDataFrame(rows, TEXT)
    spans = secret_scan.located(docs)
    labelled = [r.asDict() for r in secret_scan.samples(docs, spans).collect()]
    plain = model_by_loops([(r["value"], r["label"], r["kind"]) for r in labelled if not r["held"]])
    table = {}

    def score(value):
        c = codes(value)
        return sum(table.setdefault(p, plain(*p)) for p in zip(c, c[1:]))

    held = sorted(score(r["value"]) // 100 for r in labelled if r["held"] and not r["label"] and len(r["value"]) >= 16)
    wrong = int(0.001 * len(held))
    least = max(3000, (held[-1 - wrong] + 1) * 100)
    found = {r.doc_id: r.spans.split(",") for r in secret_scan.secrets(docs).collect()}
    total = 0
    for doc_id, text in rows:
        base = [tuple(map(int, s.split(":")[1:])) for s in found[doc_id] if not s.startswith("random")]
        wanted = [
            f"random:{m.start()}:{m.end()}" for m in re.finditer("(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{16,}", text)
            if re.search("[A-Za-z]", m[0]) and not any(s < m.end() and m.start() < e for s, e in base) and score(m[0]) >= least
        ]
        assert [s for s in found[doc_id] if s.startswith("random")] == wanted
        total += len(wanted)
    assert total > 40
