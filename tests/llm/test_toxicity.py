"""Toxicity: the decoder against all readings, counts by plain loops, disguises, held-out accuracy, odd rows."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eavista.llm import catalog, toxicity
from tests.compare import SF_DIR
from tests.llm.conftest import CLASHING, odd_rows, unlike

LABELS = "doc_id long, toxic int"


def plain_symbols(text):
    return [toxicity._symbol(c) if ord(c) < 0x250 else toxicity.OTHER for c in text]


def test_counts_equal_plain_loops(spark, odd):
    wanted = Counter()
    for row in odd_rows():
        shown = [0, 0, *plain_symbols(row[1] or ""), 0]
        wanted.update(zip(shown, shown[1:], shown[2:]))
    found = toxicity.character_counts(odd)
    assert {(i // 841, i // 29 % 29, i % 29): int(found[i]) for i in np.flatnonzero(found)} == wanted


def test_slices_count_every_trigram_once():
    text = "".join(random.Random(1).choice("ab 1é漢.") for _ in range(100))
    for size in (1, 7, 50, 100, 101):
        assert (toxicity._counts([text], size) == toxicity._counts([text])).all()


def cost_of(readings, costs):
    total, x, y = 0.0, 0, 0
    for _, emitted, price in readings:
        total += price
        for symbol in emitted:
            if symbol or y:
                total += costs[(x * 29 + y) * 29 + symbol]
                x, y = y, symbol
    return total + (costs[(x * 29 + y) * 29] if y else 0)


@pytest.mark.parametrize("separator", [None, " "])
def test_decoder_finds_the_cheapest_reading(separator):
    rng = random.Random(2)
    costs = toxicity.language_costs(toxicity._counts(["the idiot stole a loose tool", "at last all is lost"]).astype(float))
    for _ in range(150):
        span = "".join(rng.choice("aoilst10$!*" + " " * bool(separator)) for _ in range(rng.randint(1, 6)))
        runs = [toxicity._readings(c, len(list(r)), separator) for c, r in itertools.groupby(span)]
        best = min(itertools.product(*runs), key=lambda path: cost_of(path, costs))
        cheapest = cost_of(best, costs)
        options = {"".join(r[0] for r in path) for path in itertools.product(*runs) if cost_of(path, costs) < cheapest + 1e-9}
        assert toxicity.decode(span, costs, separator) in options


DISGUISED = {
    "1d10t": "idiot", "$tupid": "stupid", "i d i o t": "idiot", "p.a.t.h.e.t.i.c": "pathetic", "idiiiiot": "idiot",
    "m0r0n": "moron", "cl0wn!": "clown", "tr@sh,": "trash", "d1sgusting": "disgusting", "ID!OT": "idiot", "idiot###": "idiot",
    "s-t-u-p-i-d": "stupid", "plain": "plain", "2024-05-01": "2024-05-01", "": "",
}


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    return toxicity.fit(docs, labels)


def test_disguises_are_restored(spark, model):
    docs = spark.createDataFrame(list(enumerate(DISGUISED)), "doc_id long, text string")
    found = {r.doc_id: r.restored for r in toxicity.restored(docs, model).collect()}
    assert found == dict(enumerate(DISGUISED.values()))


def test_disguised_documents_score_as_plain_ones(spark, model):
    plain = [("you are an idiot", 1), ("you 4re an 1d10t", 1), ("you are an i d i o t", 1), ("you are an idiiiiiot", 1), ("you are early", 0)]
    scores = [toxicity.odds(model, toxicity.Restorer(model.costs).words(t)) * model.slope + model.shift for t, _ in plain]
    assert [int(s >= 0) for s in scores] == [y for _, y in plain]


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = catalog.queries()["op11_toxicity"](spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame(
        [(i, unlike(i, 30) + (" awful" if i % 2 else " lovely")) for i in range(120)], "doc_id long, text string"
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = ({r.doc_id: r.score for r in toxicity.classify(docs, given).collect()} for given in (labels, turned))
    assert first == second and min(first[i] for i in range(1, 120, 2)) > 0.5 > max(first[i] for i in range(0, 120, 2))


def test_odd_rows(spark, odd, clashing, nothing):
    labels = spark.createDataFrame([(4, 1), (12, 0), (9, 1), (13, 0), (99, None), (None, 1), (11, 7)], LABELS)
    rows = toxicity.classify(odd, labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd_rows())
    again = toxicity.classify(clashing, labels.withColumn("text", F.lit("x")).withColumn("label", F.lit(1))).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows)) and len(CLASHING) > 0
    assert toxicity.classify(nothing, labels).collect() == []
    assert {r.score for r in toxicity.classify(odd, labels.filter("toxic = 1")).collect()} == {0.5}


def test_likelihood_ratio_is_exact(spark):
    a, b, n, m = 7, 3, 20, 100
    row = spark.range(1).select(toxicity._likelihood_ratio(F.lit(a), F.lit(b), n, m).alias("g")).first()
    share = (a + b) / (n + m)
    terms = [(a, share * n), (b, share * m), (n - a, (1 - share) * n), (m - b, (1 - share) * m)]
    assert row.g == pytest.approx(2 * sum(s * math.log(s / e) for s, e in terms))
