"""Mixing sources to target weights by iterative proportional fitting, then sampling documents.

Tokens are summed once into cells of (source, language, topic). Rounds of raking scale the cells'
weights so that the totals of each margin meet its targets in turn, until every total is within
``TOLERANCE`` of its target, as a part of the target. Targets that the filled cells can not all meet
(a language of one source, say, with another target than that source) have no such end: then rounds go
on until one moves less than ``STILL`` of the error that stays, and a warning names that error.

A document is kept with the probability keep x raked share / own share of its cell. No probability is cut
at one, since that would undo the raking. Instead, default targets go only as far from the own shares as a
sample of ``keep`` of the tokens can: a margin's value gains by a third of the room (as a factor), values
that lose give what the others gain, and where cells at the end still ask for more than they have, weights and
targets are moved back together towards the own shares, by one factor for all cells, so that totals still
meet targets. Given targets are met as they are, and the sample is made smaller where a cell
would have to be kept more than whole. Whether a document is kept depends on a hash of its doc_id and
``SEED`` only, so a lost task repeats its choice.

With ``repeats`` a document may come several times: keep x raked share / own share is then its expected number
of copies. Default targets are the full powers of the own shares, targets are met whole, and the copies hold ``keep`` of
the tokens in expectation. ``copies`` has the whole part of that number, and one more by the same hash.

Cells, margins and targets stay DataFrames, as there may be as many sources as sites on the web; a
written table cuts the plan after every round. The driver sees one row a round of raking.

Defined cases: null source, lang or topic count as the empty name; a null text has no tokens, and a cell
without tokens is kept whole as no weight can reach it; an empty table gives an empty result; repeated
rows are kept or dropped together; other columns are kept as they are. Default targets go from the own shares
towards ``share ** POWER``, rescaled to one (all the way with ``repeats``); values without a given target keep their own share.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, functions as F

from eavista.llm.common import SPACES, packed, unpacked, whole_text
from eavista.session import stage

#: Default targets: a margin's own shares to this power. Below one, small values gain.
POWER = {"source": 0.5, "lang": 0.7, "topic": 0.8}
MARGINS = tuple(POWER)
#: Rounds of raking before the first test of convergence.
ROUNDS = 4
#: The largest error of a margin's total, as a part of its target (drawing documents adds far more), and the part
#: of that error which a round still moves.
TOLERANCE, STILL = 1e-4, 1e-2
#: Expected share of all tokens that is kept.
KEEP = 0.9
SEED = "mix-1"
#: Probabilities are rounded to so many places.
PLACES = 6
#: Cells that are sent to every task; more are joined with documents dealt to so many parts of a cell.
SENT_CELLS, PARTS = 100_000, 64
#: Fixed values of the default topic: bars that make a table, and words of a note and of an article.
TABLE_BARS, NOTE_WORDS, ARTICLE_WORDS = 10, 100, 1000


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACES}]+")).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """The default topic: the form of the text."""
    bars = F.char_length(text) - F.char_length(F.replace(text, F.lit("|"), F.lit("")))
    return (
        F.when(bars >= TABLE_BARS, "table")
        .when(tokens < NOTE_WORDS, "note")
        .when(tokens < ARTICLE_WORDS, "article")
        .otherwise("book")
    )


def _marked(docs: DataFrame) -> DataFrame:
    """row (the packed columns), doc_id, source, lang, topic and n_tokens of every row."""
    text = whole_text(docs)
    counted = docs.select(packed(docs), text.alias("text"), token_count(text).alias("n_tokens"))
    topic = F.col("row.topic").cast("string") if "topic" in docs.columns else topic_of(F.col("text"), F.col("n_tokens"))
    name = lambda c: F.coalesce(F.col(f"row.{c}").cast("string"), F.lit("")).alias(c)
    return counted.select(
        "row", F.col("row.doc_id").alias("doc_id"), name("source"), name("lang"),
        F.coalesce(topic, F.lit("")).alias("topic"), "n_tokens",
    )


def _with_targets(cells: DataFrame, margin: str, given: DataFrame | None, keep: float, repeats: bool) -> DataFrame:
    """``cells`` with own_<margin> and target_<margin>: shares that each sum to one over the margin's values."""
    own = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("share").alias("own"))
    if given is None:
        wanted = own.select("value", "own", F.pow("own", F.lit(POWER[margin])).alias("wanted"))
    else:
        wanted = own.join(given.select("value", "share"), "value", "left").select(
            "value", "own", F.coalesce("share", "own").alias("wanted")
        )
    total = wanted.agg(F.sum("wanted")).first()[0]
    wanted = wanted.withColumn("wanted", F.col("wanted") / F.lit(total or 1.0))
    target = F.col("wanted")
    if given is None and not repeats:
        room = keep ** (-1 / len(MARGINS)) - 1
        gain = F.greatest(F.least(F.col("wanted") - F.col("own"), F.col("own") * room), F.lit(0.0))
        loss = F.greatest(F.col("own") - F.col("wanted"), F.lit(0.0))
        row = wanted.agg(F.sum(gain).alias("gain"), F.sum(loss).alias("loss")).first()
        target = F.col("own") + gain - loss * F.lit(row["gain"] / row["loss"] if row["loss"] else 0.0)
    target = wanted.select("value", F.col("own").alias(f"own_{margin}"), target.alias(f"target_{margin}"))
    return cells.join(target, F.col(margin) == F.col("value")).drop("value")


def _progress(raked: DataFrame) -> tuple[float, float]:
    """The largest error of a margin's total and the most weight that the last round moved in one, as parts of its target."""
    parts = None
    for margin in MARGINS:
        target = F.max(f"target_{margin}")
        part = raked.groupBy(margin).agg(
            F.abs(F.sum("weight") / target - 1).alias("error"),
            (F.sum(F.abs(F.col("weight") - F.col("before"))) / target).alias("moved"),
        ).select("error", "moved")
        parts = part if parts is None else parts.unionByName(part)
    row = parts.agg(F.max("error").alias("error"), F.max("moved").alias("moved")).first()
    return row["error"] or 0.0, row["moved"] or 0.0


def rake(cells: DataFrame, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (the margins and their targets, share) with ``weight``, raked so that every margin meets its targets.

    At least ``rounds`` rounds are done.
    """
    raked, done = cells.withColumn("weight", F.col("share")), 0
    while True:
        raked = raked.withColumn("before", F.col("weight"))
        for margin in MARGINS:
            factor = raked.groupBy(F.col(margin).alias("value")).agg(
                (F.max(f"target_{margin}") / F.sum("weight")).alias("factor")
            )
            raked = raked.join(factor, F.col(margin) == F.col("value")).withColumn(
                "weight", F.col("weight") * F.col("factor")
            ).drop("value", "factor")
        raked, done = stage(raked, "raked"), done + 1
        if done >= rounds:
            error, moved = _progress(raked)
            if not error > tolerance:
                break
            if moved <= STILL * error:
                warnings.warn(f"the targets can not all be met: a margin stays off by {error:.3g} of its target")
                break
        raked = raked.drop("before")
    return raked.drop("before")


def _most(cells: DataFrame) -> float:
    """The largest factor by which a cell's weight is above its share; 1 at least."""
    return max(cells.agg(F.max(F.col("weight") / F.col("share"))).first()[0] or 1.0, 1.0)


def within_reach(cells: DataFrame, keep: float = KEEP) -> DataFrame:
    """``cells`` with weights and targets moved towards the own shares, until a sample of ``keep`` needs no cell more than whole.

    Totals are linear in the weights, so totals that meet their targets meet the moved targets.
    """
    room, most = 1 / keep, _most(cells)
    part = F.lit(1.0 if most <= room else (room - 1) / (most - 1))
    moved = {"weight": F.col("share") + part * (F.col("weight") - F.col("share"))}
    for margin in MARGINS:
        own, target = F.col(f"own_{margin}"), F.col(f"target_{margin}")
        moved[f"target_{margin}"] = own + part * (target - own)
    return cells.withColumns(moved)


def probabilities(cells: DataFrame, keep: float = KEEP) -> DataFrame:
    """``cells`` (share, weight) with ``probability``; ``keep`` of all tokens are kept, less where a cell would be kept more than whole."""
    can = 1 / _most(cells)
    if can < keep * (1 - 1e-9):
        warnings.warn(f"the targets are met with {can:.3g} of all tokens, not with {keep:.3g}")
    return cells.withColumn(
        "probability", F.round(F.least(F.col("weight") / F.col("share") * min(keep, can), F.lit(1.0)), PLACES)
    )


def expected_copies(cells: DataFrame, keep: float = KEEP) -> DataFrame:
    """``cells`` (share, weight) with ``expected``, the copies of each document, and ``probability`` of one at least."""
    expected = F.round(F.col("weight") / F.col("share") * keep, PLACES)
    return cells.withColumn("expected", expected).withColumn("probability", F.least("expected", F.lit(1.0)))


def calibrated(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, repeats: bool = False
) -> DataFrame:
    """source, lang, topic, share, weight, probability, own and target shares: one row for each cell with tokens.

    With ``repeats`` also expected, the number of copies.
    """
    cells = _marked(docs).groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")).filter("tokens > 0")
    cells = stage(cells, "cells")
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    cells = cells.withColumn("share", F.col("tokens") / F.lit(float(total))).drop("tokens")
    for margin in MARGINS:
        cells = _with_targets(cells, margin, (targets or {}).get(margin), keep, repeats)
    raked = rake(stage(cells, "targets"))
    if repeats:
        return stage(expected_copies(raked, keep), "probabilities")
    return stage(probabilities(raked if targets else within_reach(raked, keep), keep), "probabilities")


def _with_choice(docs: DataFrame, targets: dict[str, DataFrame] | None, keep: float, repeats: bool) -> DataFrame:
    """``_marked`` with probability and selected; with ``repeats`` also copies."""
    cells = calibrated(docs, targets, keep, repeats).select(
        *[F.col(m).alias(f"cell_{m}") for m in MARGINS], F.col("expected" if repeats else "probability").alias("found")
    )
    marked, (source, lang, topic) = _marked(docs), [F.col(m) == F.col(f"cell_{m}") for m in MARGINS]
    same = source & lang & topic
    if cells.count() <= SENT_CELLS:
        cells = F.broadcast(cells)
    else:
        marked = marked.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(PARTS)))
        cells = cells.withColumn("cell_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        same = same & (F.col("part") == F.col("cell_part"))
    joined = marked.join(cells, same, "left")
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(SEED)).cast("binary"))
    chance = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    found = F.coalesce("found", F.lit(1.0))
    chosen = joined.withColumn("probability", F.least(found, F.lit(1.0))).withColumn(
        "selected", chance < F.col("probability")
    )
    if not repeats:
        return chosen
    return chosen.withColumn("copies", F.floor(found) + (chance < found - F.floor(found)).cast("long"))


def mixture(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, repeats: bool = False
) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability, selected for every row; with ``repeats`` also copies."""
    chosen = _with_choice(docs, targets, keep, repeats)
    return chosen.select("doc_id", *MARGINS, "n_tokens", "probability", "selected", *["copies"] * repeats)


def sample(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, repeats: bool = False
) -> DataFrame:
    """The selected documents, with all their columns; with ``repeats`` one row a copy."""
    chosen = _with_choice(docs, targets, keep, repeats).filter("selected")
    if repeats:
        chosen = chosen.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return unpacked(chosen, docs.columns)
