"""Registered queries without SQL on the test tables, against plain Python. The others are in tests/test_catalog.py."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from eavista.llm import bpe, catalog, fingerprints
from tests.compare import SF_DIR

WORDS = re.compile(r"[^ \t-\r]+")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


def rows_of(spark, name):
    return catalog.queries()[name](spark, SF_DIR).collect()


def test_bpe_equals_the_library(spark, texts):
    library = Tokenizer.from_file(bpe.vocabulary_path())
    for row in rows_of(spark, "op1_bpe_round_trip"):
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = rows_of(spark, "op2_quality_classifier")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


ASSIGN = re.compile(
    "(" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                   for w in ("password", "passwd", "secret", "token", "api_?key"))
    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_spans(text):
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def test_secrets_equal_plain_search(spark, texts):
    for row in rows_of(spark, "op3_secret_scan"):
        wanted = base_spans(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(wanted).encode()).hexdigest()
        assert set(wanted) <= set(row.spans.split(","))
        kinds = [w.split(":")[0] for w in wanted]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))


def components_by_force(values, ids):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4):
            parent[find(i)] = find(int(j))
    low = {}
    for i, doc_id in enumerate(ids):
        low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    return [low[find(i)] for i in range(len(values))]


def test_near_duplicates_equal_brute_force(spark, texts):
    rows = rows_of(spark, "op8_simhash_dedup")
    assert len(rows) == len(texts)
    for row in rows:
        words = texts[row.doc_id].encode().lower().split()
        assert int(row.fingerprint, 16) == fingerprints.fingerprint(texts[row.doc_id]) and (words or not int(row.fingerprint, 16))
    values = np.array([int(r.fingerprint, 16) for r in rows], np.uint64)
    assert [r.component_id for r in rows] == components_by_force(values, [r.doc_id for r in rows])


def repeats_by_force(texts, size=50):
    seen, wanted = set(), {}
    for doc_id in sorted(texts):
        words = WORDS.findall(texts[doc_id])
        own = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
        gone = {j for i, window in enumerate(own) if window in seen for j in range(i, i + size)}
        seen.update(own)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        wanted[doc_id] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return wanted


def test_substrings_equal_brute_force(spark, texts):
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows_of(spark, "op9_substring_dedup")}
    assert found == repeats_by_force(texts)
    assert sum(n for _, n, _ in found.values()) > 0
