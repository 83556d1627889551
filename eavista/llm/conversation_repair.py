"""Conversation structure repair: the cheapest edits that make roles alternate, by rank-convergence parallel Viterbi.

A repaired conversation is empty, or an optional system row and then pairs of user and assistant rows.
The edits are Keep, Rerole, Delete and Insert; a dynamic program over the four places of that pattern
(``START`` to ``ASSISTANT``) finds the cheapest ones. ``costs to go`` of a row are a vector with one
number a place; a row maps the vector behind it to the vector before it.

Long conversations are cut into chunks of ``CHUNK`` rows that run in parallel:

1. Rows are dealt to tasks by ranges of (conversation, turn, digest), so that a conversation with a
   third of all rows is spread over many tasks, and cut into chunks.
2. The last chunk of a conversation starts from the true vector at its end. Every other chunk starts
   from speculative vectors: all that can stand before a row (``_vectors``, a few dozen up to a constant).
   Vectors that have come to differ by a constant only are the same from there on; most chunks are left
   with one after a few rows.
3. Fix-up passes rerun the chunks whose vectors still differ on the vectors of the chunk behind them, until
   they differ by constants only. A chunk keeps where each start leads to, so a rerun is a lookup, and a
   pass doubles the distance that is bridged: the number of passes is the logarithm of the chunks of the
   longest conversation even if no vectors ever meet.
4. The stitched costs to go are traced forward for the ASCII-least cheapest edits: each chunk is traced
   from each place at once, and the places of entry settle in the same kind of passes.

Rows of one turn go by the SHA-256 of ``role:text`` (rows with equal role and text are one row with a
count until the trace). Texts take no part until the end: they join the edits of their rows once.

Defined cases: a null conv_id is a conversation of its own; null role, text, and conv_id or turn in the
damage key, are one space; rows without turn come first; repeated rows are duplicates of the first;
an empty table gives no rows; other columns are ignored. A conversation of which nothing is left has zeros,
an empty audit and the digest of an empty text. The digest of one conversation and its audit are
sequential: one task streams its rows for them and holds the audit and one row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from eavista.llm.common import sha256
from eavista.session import literal_table, stage

CHUNK = 256
#: Damage by the checksum's remainder.
BUCKETS = 20
DROPPED, EMPTIED, UNENDED, REPEATED, AS_USER = range(5)

#: Fixed costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = PLACES = range(4)
#: Where a row with this role may be added, and the place after it.
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: The place after an added user or assistant row, whichever fits.
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Kinds of rows: the role's initial, in upper case if truncated; ``x`` must go.
KINDS = "suaoSUAO"
GONE = "x"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows that damage leaves: conv, turn, role, text, and ``copies`` of each."""
    c, blank = conversations, F.lit(" ")
    name = lambda col: F.coalesce(c[col].cast("string"), blank)
    rows = c.select(
        c["conv_id"].alias("conv"), c["turn"].alias("turn"), name("role").alias("role"), name("text").alias("text"),
        (F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % BUCKETS).alias("damage"),
    ).filter(F.col("damage") != DROPPED)
    return rows.select(
        "conv", "turn",
        F.when(F.col("damage") == AS_USER, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == EMPTIED, "").when(F.col("damage") == UNENDED, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("damage") == REPEATED, 2).otherwise(1).alias("copies"),
    ).withColumn("digest", F.unhex(sha256(F.concat("role", F.lit(":"), "text"))))


def judged(rows: DataFrame) -> DataFrame:
    """One narrow row for each (conv, turn, digest): copies, initial, blank, truncated, and first of its role and text."""
    visible = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    facts = rows.groupBy("conv", "turn", "digest").agg(
        F.sum("copies").alias("copies"),
        F.first(F.substring("role", 1, 1)).alias("initial"),
        F.first(visible == "").alias("blank"),
        F.first(~F.substring(visible, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    earliest = F.min(F.struct(F.col("turn").isNotNull().alias("later"), "turn"))
    firsts = facts.filter(~F.col("blank")).groupBy("conv", "digest").agg(earliest["turn"].alias("first_turn")).select(
        F.col("conv").alias("first_conv"), "first_turn", F.col("digest").alias("first_digest")
    )
    same = [F.col(c).eqNullSafe(F.col(f"first_{c}")) for c in ("conv", "turn", "digest")]
    return facts.join(firsts, same, "left").select(*facts.columns, F.col("first_digest").isNotNull().alias("first"))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of sorted rows: part, at, conv, kinds, counts, turns, digests, ends (initials), illegal pairs inside."""
    part, at, held = TaskContext.get().partitionId(), 0, []

    def chunk():
        rows = held[:]
        held.clear()
        initials = [r.initial for r in rows]
        illegal = sum(int(r.copies) - 1 for r in rows)
        illegal += sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        return (
            part, at, rows[0].conv, "".join(r.kind for r in rows), [int(r.copies) for r in rows],
            [r.turn for r in rows], [r.digest for r in rows], initials[0], initials[-1], illegal,
        )

    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            if held and (len(held) == CHUNK or held[-1].conv != row.conv):
                out.append(chunk())
                at += 1
            held.append(row)
        yield pd.DataFrame(out, columns=_CHUNK_NAMES)
    if held:
        yield pd.DataFrame([chunk()], columns=_CHUNK_NAMES)


_CHUNK_NAMES = ["part", "at", "conv", "kinds", "counts", "turns", "digests", "head", "tail", "illegal"]


def chunks(rows: DataFrame) -> DataFrame:
    """Numbered chunks of judged rows: ``n`` counts on through a conversation, ``first`` and ``last`` mark its ends.

    ``conv`` and turns are strings here and null is one space, so that Python sees no floating numbers.
    """
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    kind = F.when(F.col("blank") | ~F.col("first"), GONE).when(F.col("truncated"), F.upper(initial)).otherwise(initial)
    # Range bounds are drawn once a job; the chunks are written, so later jobs see the same ones.
    dealt = rows.withColumn("initial", initial).withColumn("kind", kind).repartitionByRange("conv", "turn", "digest")
    narrow = dealt.sortWithinPartitions("conv", "turn", "digest").select(
        F.coalesce(F.col("conv").cast("string"), F.lit(" ")).alias("conv"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")).alias("turn"), "digest", "copies", "initial", "kind",
    )
    cut = stage(narrow.mapInPandas(
        _cut, "part int, at long, conv string, kinds string, counts array<long>, turns array<string>,"
              " digests array<binary>, head string, tail string, illegal long"
    ), "conversation-chunks")
    # One row a partition of the shuffle above.
    sizes = sorted(tuple(r) for r in cut.groupBy("part").agg(F.max("at") + 1).collect())
    offsets, total = [], 0
    for part, size in sizes:
        offsets.append((part, total))
        total += size
    starts = literal_table(cut.sparkSession, "part int, before bigint", offsets or [(0, 0)])
    numbered = cut.join(F.broadcast(starts), "part").withColumn("n", F.col("before") + F.col("at")).drop("part", "at", "before")
    ends = numbered.select("n", "conv", "tail", "head")
    before = ends.select((F.col("n") + 1).alias("n"), F.col("conv").alias("conv"), F.col("tail").alias("earlier"))
    after = ends.select((F.col("n") - 1).alias("n"), F.col("conv").alias("conv"), F.lit(False).alias("last"))
    pair = F.concat("earlier", "head")
    return numbered.join(before, ["n", "conv"], "left").join(after, ["n", "conv"], "left").select(
        "n", "conv", "kinds", "counts", "turns", "digests",
        (F.col("illegal") + F.when(F.col("earlier").isNotNull() & ~pair.isin("su", "ua", "au"), 1).otherwise(0)).alias("illegal"),
        F.col("earlier").isNull().alias("first"), F.coalesce("last", F.lit(True)).alias("last"),
    )


Vector = tuple[int, int, int, int]


#: More than any finite difference of costs.
NO_WAY = 10**6


def _with_inserts(costs: list[int]) -> list[int]:
    """Costs to go when rows may be inserted first."""
    for _ in PLACES:
        costs = [min(costs[p], INSERT + costs[NEXT[p]]) for p in PLACES]
    return costs


def _leveled(costs: list[int]) -> Vector:
    return tuple(c - min(costs) for c in costs)


#: Behind the last row a conversation may end empty or after an assistant.
END: Vector = _leveled(_with_inserts([0, NO_WAY, NO_WAY, 0]))


def _ways(kind: str, behind: Vector) -> list[int]:
    """The cheapest cost to go from every place before a live row, on the scale of the vector behind it."""
    stays, keep = TRUNCATED if kind.isupper() else 0, AFTER.get(kind.lower(), {})
    return [
        min(DELETE + behind[p], REROLE + stays + behind[NEXT[p]], stays + behind[keep[p]] if p in keep else NO_WAY)
        for p in PLACES
    ]


@cache
def _before(kind: str, behind: Vector) -> Vector:
    """Costs to go before a row of a kind, up to a constant."""
    return behind if kind == GONE else _leveled(_with_inserts(_ways(kind, behind)))


@cache
def _vectors() -> tuple[Vector, ...]:
    """All vectors, up to a constant, that can stand before a row: what the kinds of rows make of ``END``."""
    found, fresh = {END}, [END]
    while fresh:
        fresh = list({_before(kind, v) for v in fresh for kind in KINDS} - found)
        found.update(fresh)
    return tuple(sorted(found))


def speculated(kinds: str, last: bool) -> list[int]:
    """For each vector that may stand behind a chunk, the number of the vector before it."""
    numbers = {v: i for i, v in enumerate(_vectors())}
    starts = [END] * len(numbers) if last else list(_vectors())
    leads = {v: v for v in starts}
    for kind in reversed(kinds):
        moved = {v: _before(kind, v) for v in set(leads.values())}
        leads = {start: moved[v] for start, v in leads.items()}
    return [numbers[leads[v]] for v in starts]


def _behind(kinds: str, vector: Vector) -> list[Vector]:
    """The vectors behind every row of a chunk, from the one behind the last."""
    found = [vector]
    for kind in reversed(kinds[1:]):
        found.append(_before(kind, found[-1]))
    return found[::-1]


def trace(kinds: str, vectors: list[Vector], place: int, last: bool) -> tuple[list[tuple[str, int]], int]:
    """The ASCII-least cheapest edits of a chunk from a place, each with the place after it, and the place of exit.

    ``vectors`` stand behind the rows. Rows that must go are deleted at once, as ``D`` comes before every
    other initial; rows are inserted as late as that allows.
    """
    edits = []
    for kind, behind in zip(kinds, vectors):
        if kind == GONE:
            edits.append(("D", place))
            continue
        stays, keep = TRUNCATED if kind.isupper() else 0, AFTER.get(kind.lower(), {})
        least = _with_inserts(_ways(kind, behind))
        while DELETE + behind[place] != least[place] and INSERT + least[NEXT[place]] == least[place]:
            place = NEXT[place]
            edits.append(("I", place))
        if DELETE + behind[place] == least[place]:
            edits.append(("D", place))
        elif place in keep and stays + behind[keep[place]] == least[place]:
            place = keep[place]
            edits.append(("K", place))
        else:
            place = NEXT[place]
            edits.append(("R", place))
    while last and place in (SYSTEM, USER):
        place = NEXT[place]
        edits.append(("I", place))
    return edits, place


def settled(maps: DataFrame, step: int) -> DataFrame:
    """n and ``value``: what stands at a chunk's open end, for maps (n, leads, fixed) composed along ``n + step``.

    ``leads`` is a chunk's outcome for each value at the end where ``step`` points; a chunk whose outcomes are
    equal is settled. Every pass puts the outcomes of the chunk it waits for in place of its own and then
    waits for the one that chunk waited for. All chunks at the ends are settled, so passes end.
    """
    single = F.array_size(F.array_distinct("leads")) == 1
    now = maps.select("n", "leads", (F.col("n") + step).alias("waits"), single.alias("ready"))
    while True:
        now = stage(now, "conversation-pass")
        if now.filter(~F.col("ready")).isEmpty():
            return now.select("n", F.col("leads")[0].alias("value"))
        there = now.select(F.col("n").alias("waits"), F.col("leads").alias("there"), F.col("waits").alias("further"))
        joined = now.filter(~F.col("ready")).join(there, "waits").select(
            "n", F.transform("there", lambda i: F.get(F.col("leads"), i)).alias("leads"), F.col("further").alias("waits"),
        ).withColumn("ready", single)
        now = now.filter("ready").unionByName(joined)


def _with_values(cut: DataFrame, values: DataFrame, step: int, name: str, otherwise: int) -> DataFrame:
    """Chunks with the value of the chunk at ``n + step`` of the same conversation."""
    moved = values.select((F.col("n") - step).alias("n"), F.col("value").alias(name))
    edge = F.col("last") if step > 0 else F.col("first")
    return cut.join(moved, "n", "left").withColumn(name, F.when(edge, otherwise).otherwise(F.col(name)))


def placed(cut: DataFrame) -> DataFrame:
    """Chunks with ``behind``, the number of the true vector behind them, and ``place``, where their trace enters."""
    slim = cut.select("n", "kinds", "first", "last")
    long = stage(slim.filter(~(F.col("first") & F.col("last"))), "conversation-long")

    @F.pandas_udf("array<int>")
    def outcomes(kinds: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series([speculated(k, e) for k, e in zip(kinds, last)])

    @F.pandas_udf("array<int>")
    def exits(kinds: pd.Series, behind: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
        found = []
        for k, b, f, e in zip(kinds, behind, first, last):
            vectors = _behind(k, _vectors()[b])
            found.append([trace(k, vectors, START if f else p, e)[1] for p in PLACES])
        return pd.Series(found)

    end = _vectors().index(END)
    vectors = settled(long.select("n", outcomes("kinds", "last").alias("leads")), 1)
    known = stage(_with_values(long, vectors, 1, "behind", end), "conversation-known")
    places = settled(known.select("n", exits("kinds", "behind", "first", "last").alias("leads")), -1)
    entries = _with_values(known, places, -1, "place", START).select("n", "behind", "place")
    joined = cut.join(entries, "n", "left")
    return joined.withColumn("behind", F.coalesce("behind", F.lit(end))).withColumn("place", F.coalesce("place", F.lit(START)))


def _edits(
    kinds: pd.Series, counts: pd.Series, behind: pd.Series, place: pd.Series, last: pd.Series
) -> pd.DataFrame:
    """For each row of a chunk, with what is inserted before it: the roles to write, the audit's letters, the cost.

    The roles are null where nothing is written, else separated by commas: ``=`` is the row itself, ``=user`` the
    row with another role, ``user`` an inserted row. Rows inserted at the end of a conversation follow as one more.
    """
    found = []
    for k, n, b, p, e in zip(kinds, counts, behind, place, last):
        steps, _ = trace(k, _behind(k, _vectors()[b]), p, e)
        roles, parts, costs, i, letters, written, cost = [], [], [], 0, "", [], 0
        for letter, after in steps:
            letters += letter
            if letter == "I":
                written.append(ROLE[after])
                cost += INSERT
                continue
            more = int(n[i]) - 1  # further copies of a row are duplicates
            cost += {"K": 0, "R": REROLE, "D": DELETE}[letter] + DELETE * more
            cost += TRUNCATED if k[i].isupper() and letter != "D" else 0
            if letter != "D":
                written.append("=" if letter == "K" else "=" + ROLE[after])
            roles.append(",".join(written) or None)
            parts.append(letters + "D" * more)
            costs.append(cost)
            i, letters, written, cost = i + 1, "", [], 0
        if letters:
            roles.append(",".join(written))
            parts.append(letters)
            costs.append(cost)
        found.append((roles, parts, costs))
    return pd.DataFrame(found, columns=["roles", "parts", "costs"])


def _streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """conv, cost, audit and digest of each conversation from its sorted edits, one row held at a time."""
    conv, digest, empty, audit, cost = None, None, True, [], 0
    for batch in batches:
        out = []
        for name, role, letters, price, own, text in zip(
            batch["conv"], batch["edit_role"], batch["part"], batch["cost"], batch["role"], batch["text"]
        ):
            if name != conv:
                if conv is not None:
                    out.append((conv, cost, "".join(audit), digest.hexdigest()))
                conv, digest, empty, audit, cost = name, hashlib.sha256(), True, [], 0
            audit.append(letters)
            cost += int(price)
            for added in role.split(",") if isinstance(role, str) else ():
                line = f"{added[1:] or own}:{text}" if added[0] == "=" else f"{added}:"
                digest.update((line if empty else "\n" + line).encode())
                empty = False
        yield pd.DataFrame(out, columns=["conv", "cost", "audit", "repaired_sha256"])
    if conv is not None:
        yield pd.DataFrame([(conv, cost, "".join(audit), digest.hexdigest())], columns=["conv", "cost", "audit", "repaired_sha256"])


def edits(cut: DataFrame) -> DataFrame:
    """One row for each group of equal rows, in order of (n, at): its key, the roles it becomes, audit letters and cost."""
    told = F.pandas_udf(_edits, "roles array<string>, parts array<string>, costs array<int>")
    made = placed(cut).select("n", "conv", "turns", "digests", told("kinds", "counts", "behind", "place", "last").alias("e"))
    zipped = F.arrays_zip(
        F.col("turns").alias("turn"), F.col("digests").alias("digest"), F.col("e.roles").alias("edit_role"),
        F.col("e.parts").alias("part"), F.col("e.costs").alias("cost"),
    )
    return made.select("n", "conv", F.posexplode(zipped).alias("at", "e")).select("n", "conv", "at", "e.*")


def repairs(conversations: DataFrame) -> DataFrame:
    """One row for every conv_id: faults, the cheapest edits and the digest of the repaired rows."""
    rows = damaged(conversations)
    facts = stage(judged(rows), "conversation-rows")
    cut = stage(chunks(facts), "conversation-cut")
    named = lambda col: F.coalesce(F.col(col).cast("string"), F.lit(" "))
    made = edits(cut)
    # Equal rows are one text; the aggregate and the join share one exchange of the texts.
    texts = rows.groupBy(named("conv").alias("conv"), named("turn").alias("turn"), "digest").agg(
        F.first("role").alias("role"), F.first("text").alias("text")
    )
    used = made.join(texts, ["conv", "turn", "digest"], "left").select("n", "at", "conv", "edit_role", "part", "cost", "role", "text")
    streamed = used.repartition("conv").sortWithinPartitions("conv", "n", "at").mapInPandas(
        _streamed, "conv string, cost long, audit string, repaired_sha256 string"
    )
    copies, fresh = F.col("copies"), ~F.col("blank") & F.col("first")
    total = lambda condition, value: F.sum(F.when(condition, value).otherwise(0))
    faults = facts.groupBy(named("conv").alias("conv")).agg(
        (F.coalesce(F.max("turn") - F.min("turn") + 1, F.lit(0)) - F.countDistinct("turn")).alias("gaps"),
        total(F.col("blank"), copies).alias("blank"),
        total(~F.col("blank"), copies - F.when(fresh, 1).otherwise(0)).alias("duplicate"),
        total(fresh & F.col("truncated"), 1).alias("truncated"),
    )
    pairs = cut.groupBy("conv").agg(F.sum("illegal").alias("illegal"))
    ids = conversations.select(conversations["conv_id"].alias("conv_id")).distinct().withColumn("conv", named("conv_id"))
    number = lambda col: F.coalesce(F.col(col), F.lit(0)).cast("long").alias(col)
    return ids.join(faults, "conv", "left").join(pairs, "conv", "left").join(streamed, "conv", "left").select(
        "conv_id", *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
