"""Conversation repair against a plain recursion over whole conversations."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from eavista.llm import catalog, conversation_repair
from tests.compare import SF_DIR

COLUMNS = "conv_id long, turn long, role string, text string"


def best_audit(rows):
    """(cost, audit) of rows (initial, must go, truncated): all edits are tried from the back."""
    follows = {("", "u"), ("s", "u"), ("u", "a"), ("a", "u"), ("", "s")}

    @cache
    def best(i, at, inserted):
        ways = []
        if i == len(rows) and at in ("", "a"):
            ways.append((0, ""))
        ways += [(2, "I", i, r, inserted + 1) for r in "ua" if (at, r) in follows and inserted < 4]
        if i < len(rows):
            initial, gone, cut = rows[i]
            ways.append((3, "D", i + 1, at, 0))
            if not gone:
                ways += [(cut, "K", i + 1, initial, 0)] if (at, initial) in follows else []
                ways += [(2 + cut, "R", i + 1, r, 0) for r in "ua" if (at, r) in follows]
        found = []
        for way in ways:
            if len(way) == 2:
                found.append(way)
            elif (rest := best(*way[2:])) is not None:
                found.append((way[0] + rest[0], way[1] + rest[1]))
        return min(found, default=None)

    # From the back, so that the recursion stays flat.
    for i in range(len(rows), -1, -1):
        for at in ("", "s", "u", "a"):
            best(i, at, 0)
    return best(0, "", 0)


def by_force(table):
    """The contract's row of every conversation."""
    damaged = {}
    for conv, turn, role, text in table:
        kept = damaged.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        damage = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if damage == 1:
            text = ""
        elif damage == 2:
            text = re.sub("[.!?]", "", text)
        elif damage == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if damage == 0 else 2 if damage == 3 else 1)
    found = {}
    for conv, rows in damaged.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{r[1]}:{r[2]}".encode()).digest()))
        turns = [t for t, _, _ in rows if t is not None]
        seen, faults = set(), []
        for _, role, text in rows:
            shown = re.findall(r"[^ \t-\r]", text)
            faults.append(
                "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            )
            seen.add((role, text))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
        cost, audit = best_audit(tuple(
            (role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")) for (_, role, _), fault in zip(rows, faults)
        ))
        written, left = [], iter(rows)
        for letter in audit:
            row = next(left) if letter != "I" else None
            turned = "assistant" if written and written[-1][0][:1] == "u" else "user"
            if letter != "D":
                written.append((row[1] if letter == "K" else turned, "" if letter == "I" else row[2]))
        found[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in written).encode()).hexdigest(),
        )
    return found


def rows_of(df):
    return {tuple(r)[0]: tuple(r)[1:] for r in df.collect()}


def test_registered_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    found = rows_of(catalog.queries()["op13_conversation_repair"](spark, SF_DIR))
    assert found == by_force([tuple(r) for r in table])


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Well then!", "", " \n", "a b", "?", "Long text. " * 3]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "unit", "spoken"]
    rows = []
    for conv in range(conversations):
        likely = rng.sample(roles, 3)
        for turn in range(rng.randint(1, longest)):
            own = rng.choice(texts) if rng.random() < 0.3 else f"{rng.random()}" + rng.choice([".", "", " !"])
            rows.append((conv, None if rng.random() < 0.05 else turn * rng.randint(1, 2), rng.choice(likely), own))
    rows += [(None, 3, None, None), (None, None, "user", "x."), (7, None, "user", None), (7, 1, "user", "x.")] + rows[:40]
    return rows


@pytest.mark.parametrize("chunk", [1, 3, 256])
def test_chunks_of_any_size(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversation_repair, "CHUNK", chunk)
    rows = random_rows(chunk, 12, 60)
    assert rows_of(conversation_repair.repairs(spark.createDataFrame(rows, COLUMNS))) == by_force(rows)


@pytest.mark.parametrize("make", [
    lambda i: (1, i, "user", f"{i}."),  # vectors that never meet: one role throughout
    lambda i: (1, i, "assistant", "same."),  # nothing but duplicates
    lambda i: (1, 5, "user" if i % 3 else "assistant", f"{i}"),  # one turn
    lambda i: (1, None, "system", f"{i}."),
])
def test_long_conversations(spark, monkeypatch, make):
    monkeypatch.setattr(conversation_repair, "CHUNK", 7)
    rows = [make(i) for i in range(700)]
    assert rows_of(conversation_repair.repairs(spark.createDataFrame(rows, COLUMNS))) == by_force(rows)


def test_passes_grow_with_the_logarithm(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "CHUNK", 2)
    passes = []
    write = conversation_repair.stage

    def counted(df, name):
        passes.append(name)
        return write(df, name)

    monkeypatch.setattr(conversation_repair, "stage", counted)
    rows = [(1, i, "user", f"{i}.") for i in range(600)]
    conversation_repair.repairs(spark.createDataFrame(rows, COLUMNS)).collect()
    assert passes.count("conversation-pass") <= 2 * 11


def test_odd_tables(spark):
    wide = spark.createDataFrame(random_rows(5, 4, 9), COLUMNS)
    clash = wide.select("*", *[F.lit(i).alias(c) for i, c in enumerate(("conv", "n", "kind", "digest", "copies", "part", "value"))])
    assert rows_of(conversation_repair.repairs(clash)) == rows_of(conversation_repair.repairs(wide))
    assert conversation_repair.repairs(wide.limit(0)).collect() == []
    assert conversation_repair.repairs(wide).columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    ]
    long = [(1, 0, "user", "word " * 200_000 + "."), (1, 1, "assistant", "é" * 300_000), (1, 1, "assistant", "é" * 300_000)]
    assert rows_of(conversation_repair.repairs(spark.createDataFrame(long, COLUMNS))) == by_force(long)


def test_every_vector_is_bounded():
    vectors = conversation_repair._vectors()
    assert conversation_repair.END in vectors and len(vectors) < 40
    assert all(min(v) == 0 and max(v) <= 6 for v in vectors)
