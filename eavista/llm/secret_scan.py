"""Secret scan: format rules, and character Markov models of random strings and ordinary identifiers.

Two first-order models over the characters of keys are trained from labelled samples, one row per
string. A candidate (a run of key characters outside all base spans, with a letter) is a secret when
its log-likelihood under the model of random strings exceeds that under the model of ordinary
identifiers by a threshold. No candidate is a sample:

* Random strings are drawn from a seed over several alphabets, beside the values of base spans that
  have the look of keys. Every alphabet, and the found ones together, weigh the same.
* Ordinary identifiers are made of the corpus: every distinct word outside base spans, alone and joined in
  the ways of ``FORMS``. Every way weighs the same. Words of all documents count, so the model grows with them.

A quarter of both, chosen by a hash of the word or the string, is held out. The threshold is the least
whole score that takes at most ``MAX_WRONG`` of the held-out identifiers that are as long as
candidates, and at least ``MIN_RATIO``. The driver gets at most one row a pair of characters and kind of
sample, and one a step of the score; there the counts become one table of ratios in thousandths, so
that scores are exact whole numbers. A run of one character counts once in scores and samples. All else
are DataFrame functions. A class without samples counts as uniform.

Spans are counted in code points, end exclusive. Starts are running sums of the lengths of gaps and
matches, built in blocks so that a text with very many matches stays cheap.

Defined cases: a null text counts as empty and has no spans; repeated rows are scanned alike; other
columns are ignored; a table without words leaves ``MIN_RATIO`` as the threshold.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from eavista.llm.common import let, sha256, whole_text
from eavista.session import stage


class Kind(NamedTuple):
    name: str
    pattern: str
    #: Group whose length counts, and the least length.
    group: int
    least: int


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: The base formats. What looks around only spares the matcher places that can not match.
ASSIGN = (
    "(?=[AaPpSsTt])(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + ")"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE = (
    Kind("assign", ASSIGN, 2, 6),
    Kind("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    Kind("hex", "(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)
#: The spans that the models add.
MODEL_KIND = "random"
#: Runs that the models judge; they are at least 16 characters long.
CANDIDATE = "(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{16,}"
#: Whole words and joined words of a text, and the words inside them.
TOKEN = "(?<![A-Za-z0-9+/=_-])[A-Za-z]+(?:[_-][A-Za-z]+)*(?![A-Za-z0-9+/=_-])"
WORD = "[A-Z]?[a-z]{2,}|[A-Z]{3,}(?![a-z])"
#: How a word, in lower case (w), upper case (u) and with a capital (c), stands in identifiers; n is a number.
FORMS = (
    "w", "u", "c", "concat_ws('_', w, w, w)", "concat_ws('-', w, w, w)", "concat_ws('/', w, w, w)", "concat(w, '=', w)",
    "concat(w, '+', w)", "concat_ws('_', u, u, u)", "concat(w, c, c)", "concat(c, c, c)", "concat(w, w, w)", "concat(w, n)",
    "concat(w, '_', n, '-', n)", "concat(u, '-', n)", "concat(n, '-', n, 'T', n, '-', n)",
)
#: Alphabets of random strings, how many are drawn from each, their lengths, and the seed.
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = (
    _UPPER + _LOWER + _DIGITS, _UPPER + _LOWER + _DIGITS + "+/", _UPPER + _LOWER + _DIGITS + "-_", _UPPER + _DIGITS,
    _LOWER + _DIGITS, _DIGITS + "ABCDEF", _DIGITS + "abcdef", _UPPER + _LOWER,
)
DRAWN, SHORTEST, LONGEST, SEED = 1000, 16, 48, 7
#: Characters in the order of the alphabet and of keyboards are ordinary too.
ORDERED = (_LOWER, _DIGITS, "qwertyuiop", "asdfghjkl", "zxcvbnm")
#: Codes from "+" to "z" are the models' states.
FIRST_CODE, STATES = 43, 80
ALPHABET = 66
#: Log-likelihood ratio, in thousandths, that a secret has at least; added to each count; and the part of every
#: step's probability that is uniform, so that no pair of letters a corpus happens to lack decides alone.
MIN_RATIO, SMOOTHING, UNIFORM = 3_000, 0.5, 0.1
#: The largest share of held-out identifiers taken for secrets, one of HELD samples held out, and the step of scores.
MAX_WRONG, HELD, STEP = 0.001, 4, 100
#: Candidates have at least this length.
LEAST = 16
_BLOCK = 256


def _positions(text: Column, pattern: str, group: int) -> Column:
    """Array of (start, end, value) of all matches, with the text of the group in ``value``."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else None

    def sized(gap: Column, match: Column) -> Column:
        return F.struct(gap.alias("gap"), F.coalesce(F.char_length(match), F.lit(0)).alias("size"), match.alias("value"))

    steps = F.zip_with(gaps, matches, sized)
    if values is not None:
        steps = F.zip_with(steps, values, lambda s, v: F.struct(s["gap"], s["size"], v.alias("value")))

    def blocked(steps: Column) -> Column:
        last = F.floor((F.size(steps) - 1) / _BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(steps, b * _BLOCK + 1, _BLOCK))

    def begins(blocks: Column) -> Column:
        sums = F.transform(
            blocks, lambda block: F.aggregate(block, F.lit(0), lambda total, s: total + s["gap"] + s["size"])
        )
        return F.aggregate(
            sums, F.array(F.lit(0)), lambda known, s: F.concat(known, F.array(F.element_at(known, -1) + s))
        )

    nothing = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(done: Column, s: Column) -> Column:
        begin = done["at"] + s["gap"]
        found = F.struct(begin.alias("start"), (begin + s["size"]).alias("end"), s["value"].alias("value"))
        return F.struct((begin + s["size"]).alias("at"), F.concat(done["out"], F.array(found)).alias("out"))

    def placed(blocks: Column, before: Column) -> Column:
        return F.flatten(F.transform(blocks, lambda block, b: F.aggregate(
            block, F.struct(F.element_at(before, b + 1).alias("at"), nothing.alias("out")), step, lambda d: d["out"]
        )))

    spans = let(steps, lambda s: let(blocked(s), lambda blocks: let(begins(blocks), lambda b: placed(blocks, b))))
    return F.filter(spans, lambda s: s["end"] > s["start"])


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    """``_positions`` of texts that match at all; most do not and are read once."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), _positions(text, pattern, group)).otherwise(none)


def _base(text: Column) -> dict[str, Column]:
    def passing(kind: Kind) -> Column:
        return F.filter(_found(text, kind.pattern, kind.group), lambda s: F.char_length(s["value"]) >= kind.least)

    return {kind.name: passing(kind) for kind in BASE}


def _candidates(text: Column, base: Column) -> Column:
    """Candidate spans with a letter that touch no base span."""
    return F.filter(
        _found(text, CANDIDATE),
        lambda s: s["value"].rlike("[A-Za-z]")
        & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )


def located(docs: DataFrame) -> DataFrame:
    """doc_id, assign, access, hex, candidates: arrays of (start, end, value); all that needs the texts."""
    text = whole_text(docs)
    found = docs.select(docs["doc_id"].alias("doc_id"), text.alias("text"))
    found = found.select("doc_id", "text", *[c.alias(n) for n, c in _base(F.col("text")).items()])
    base = F.concat(*[F.col(k.name) for k in BASE])
    return found.withColumn("candidates", _candidates(F.col("text"), base)).drop("text")


def _held(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(HELD)) == 0


def words(docs: DataFrame) -> DataFrame:
    """word: every distinct word of the texts outside base spans, in lower case."""
    text = whole_text(docs)
    for kind in BASE:
        text = F.when(text.rlike(kind.pattern), F.regexp_replace(text, kind.pattern, " ")).otherwise(text)
    tokens = docs.select(F.explode(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))).alias("token")).distinct()
    found = tokens.select(F.explode(F.regexp_extract_all("token", F.lit(WORD), F.lit(0))).alias("word"))
    return found.select(F.lower("word").alias("word")).distinct()


def ordinary(words: DataFrame) -> DataFrame:
    """value, label 0, kind, held: every word in every form."""
    number = F.pmod(F.xxhash64(F.lit("number"), "word"), F.lit(100_000)).cast("string")
    named = words.select(
        _held(F.col("word")).alias("held"), F.col("word").alias("w"), F.upper("word").alias("u"),
        F.concat(F.upper(F.substring("word", 1, 1)), F.expr("substring(word, 2)")).alias("c"), number.alias("n"),
    )
    forms = F.array(*[F.struct(F.lit(i).alias("kind"), F.expr(form).alias("value")) for i, form in enumerate(FORMS)])
    return named.select("held", F.explode(forms).alias("f")).select("f.value", F.lit(0).alias("label"), "f.kind", "held")


def drawn(spark: SparkSession, count: int = DRAWN) -> DataFrame:
    """value, label 1, kind, held: random strings over every alphabet, the same in every run."""
    letters = F.array(*[F.lit(alphabet) for alphabet in ALPHABETS])
    place = lambda i: F.xxhash64(F.lit(SEED), "id", "kind", i)
    size = (F.pmod(place(F.lit(-1)), F.lit(LONGEST - SHORTEST + 1)) + SHORTEST - 1).cast("int")
    strings = spark.range(count).select("id", F.posexplode(letters).alias("kind", "letters"))
    characters = F.transform(
        F.sequence(F.lit(0), size),
        lambda i: F.substr("letters", F.pmod(place(i), F.char_length("letters")).cast("int") + 1, F.lit(1)),
    )
    made = strings.select("kind", F.array_join(characters, "").alias("value"))
    return made.select("value", F.lit(1).alias("label"), "kind", _held(F.col("value")).alias("held"))


def found_keys(spans: DataFrame) -> DataFrame:
    """value, label 1, kind, held: values of base spans with letters and digits, as long as candidates."""
    every = F.concat(*[F.transform(k.name, lambda s: s["value"]) for k in BASE])
    values = spans.select(F.explode(every).alias("value")).distinct()
    like_keys = (F.char_length("value") >= LEAST) & F.col("value").rlike("[A-Za-z]") & F.col("value").rlike("[0-9]")
    return values.filter(like_keys).select(
        "value", F.lit(1).alias("label"), F.lit(len(ALPHABETS)).alias("kind"), _held(F.col("value")).alias("held")
    )


def ordered(spark: SparkSession) -> DataFrame:
    """value, label 0, kind, held: the sequences of ``ORDERED`` in both cases; all are learned."""
    sequences = F.array(*[F.lit(case) for row in ORDERED for case in sorted({row, row.upper()})])
    return spark.range(1).select(F.explode(sequences).alias("value")).select(
        "value", F.lit(0).alias("label"), F.lit(len(FORMS)).alias("kind"), F.lit(False).alias("held")
    )


def samples(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """value, label (1: random), kind, held; ``spans`` is ``located(docs)``."""
    return ordinary(words(docs)).unionByName(ordered(docs.sparkSession)).unionByName(
        drawn(docs.sparkSession)
    ).unionByName(found_keys(spans))


def _codes(value: Column) -> Column:
    once = F.regexp_replace(value, r"(.)\1+", "$1")
    return F.transform(F.split(once, ""), lambda c: F.ascii(c) - FIRST_CODE)


def train(labelled: DataFrame) -> list[int]:
    """Ratios in thousandths for every (state, next state), from columns value, label (1: random) and kind."""
    codes = labelled.filter("label IN (0, 1) AND value IS NOT NULL").select("label", "kind", _codes(F.col("value")).alias("c"))
    steps = codes.filter(F.size("c") > 1).select(
        "label", "kind",
        F.explode(F.transform(
            F.sequence(F.lit(1), F.size("c") - 1),
            lambda i: F.struct(F.element_at("c", i).alias("now"), F.element_at("c", i + 1).alias("then")),
        )).alias("step"),
    )
    known = steps.select("label", "kind", "step.now", "step.then").filter(
        f"now BETWEEN 0 AND {STATES - 1} AND then BETWEEN 0 AND {STATES - 1}"
    )
    counted = known.groupBy("label", "kind", "now", "then").agg(F.count("*").alias("n")).collect()
    masses: dict[tuple[int, int], int] = {}
    for r in counted:
        masses[r.label, r.kind] = masses.get((r.label, r.kind), 0) + r.n
    # every kind of a class weighs as much as the mean of its kinds
    mean = {c: sum(mass) / len(mass) for c in (0, 1) if (mass := [n for (label, _), n in masses.items() if label == c])}
    counts: dict[tuple[int, int, int], float] = {}
    totals: dict[tuple[int, int], float] = {}
    for r in sorted(counted):
        weight = r.n * mean[r.label] / masses[r.label, r.kind]
        counts[r.label, r.now, r.then] = counts.get((r.label, r.now, r.then), 0) + weight
        totals[r.label, r.now] = totals.get((r.label, r.now), 0) + weight

    def log(label: int, now: int, then: int) -> float:
        seen = counts.get((label, now, then), 0) + SMOOTHING
        learned = seen / (totals.get((label, now), 0) + SMOOTHING * ALPHABET)
        return math.log((1 - UNIFORM) * learned + UNIFORM / ALPHABET)

    return [
        round(1000 * (log(1, now, then) - log(0, now, then))) for now in range(STATES) for then in range(STATES)
    ]


def _histogram(held: DataFrame, model: list[int]) -> list[Row]:
    """label, step, n of the samples as long as candidates: whole steps of their scores."""
    long = held.filter(F.char_length("value") >= LEAST)
    step = F.floor(ratio(F.col("value"), model) / STEP).alias("step")
    return long.select("label", step).groupBy("label", "step").agg(F.count("*").alias("n")).collect()


def threshold(held: DataFrame, model: list[int]) -> int:
    """The least score that takes at most ``MAX_WRONG`` of held-out ordinary samples, at least ``MIN_RATIO``."""
    steps = sorted(((r.step, r.n) for r in _histogram(held, model) if r.label == 0), reverse=True)
    allowed, taken = MAX_WRONG * sum(n for _, n in steps), 0
    for step, n in steps:
        taken += n
        if taken > allowed:
            return max(MIN_RATIO, (step + 1) * STEP)
    return MIN_RATIO


def ratio(value: Column, model: list[int]) -> Column:
    """Log-likelihood ratio of a string, in thousandths."""
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<int>")
    start = F.struct(F.lit(-1).alias("last"), F.lit(0).cast("long").alias("sum"))

    def step(done: Column, code: Column) -> Column:
        gain = F.when(done["last"] >= 0, F.element_at(table, done["last"] * STATES + code + 1)).otherwise(0)
        return F.struct(code.alias("last"), (done["sum"] + gain).alias("sum"))

    return F.aggregate(_codes(value), start, step, lambda done: done["sum"])


def scan(spans: DataFrame, model: list[int], least: int = MIN_RATIO) -> DataFrame:
    """doc_id, spans: array of (start, kind_no, end, kind) in order, for every row of ``located``.

    Candidates that score ``least`` or more are spans.
    """
    names = [k.name for k in BASE]

    def kind(spans: Column, number: int, name: str) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("kind_no"), s["end"].alias("end"), F.lit(name).alias("kind")
        ))

    model_spans = F.filter("candidates", lambda s: ratio(s["value"], model) >= least)
    parts = [kind(F.col(n), i, n) for i, n in enumerate(names)] + [kind(model_spans, len(names), MODEL_KIND)]
    return spans.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans; ordinary words are those of ``docs`` itself."""
    spans = stage(located(docs), "spans")
    labelled = stage(samples(docs, spans), "samples")
    model = train(labelled.filter("NOT held"))
    found = scan(spans, model, threshold(labelled.filter("held"), model))
    base = F.filter("spans", lambda s: s["kind"] != MODEL_KIND)

    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    return found.select(
        "doc_id",
        *[count(kind.name) for kind in BASE],
        sha256(listed(base)).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
