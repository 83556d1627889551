"""Locally consistent parsing of word sequences by recompression, over many documents at a time.

Words are named by 64-bit hashes. The first round gives every maximal run of one word a name made of
the word's name and the run's length. Each later round colours all names left or right by a bit of
their hash and gives every neighbouring (left, right) pair one name made of the two. As names are
functions of content only, the whole corpus shares one naming without a table: equal symbols stand
for equal words everywhere.

Every symbol carries the span of words its existence depends on: a pair depends on its two parts
only, a left symbol that stays single also on its right neighbour, a right one on its left neighbour,
a run on the words beside it; what lies beyond a document's end never counts as known. A symbol
whose whole context lies inside a window therefore occurs in every other copy of the window.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import xxhash

ROUNDS = 4
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Beyond any document.
FAR = np.int64(1) << 40


def mix(first: np.ndarray, second: np.ndarray, salt: int = 0) -> np.ndarray:
    """One name for two."""
    z = (first * _A + np.uint64(salt)) ^ (second + (first >> np.uint64(31)))
    z = (z ^ (z >> np.uint64(30))) * _B
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def word_names(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Anchors(NamedTuple):
    """Names of anchors, their document, and the span of words, within the document, that decides them."""

    name: np.ndarray
    doc: np.ndarray
    low: np.ndarray
    high: np.ndarray


def anchors(names: np.ndarray, doc: np.ndarray, place: np.ndarray, rounds: int = ROUNDS) -> Anchors:
    """Anchors of documents laid end to end; ``doc`` numbers them, ``place`` counts words within each.

    An anchor is a symbol of the last round whose name is smaller than both neighbours' names; it is
    named by all three.
    """
    name, low, high = names, place.copy(), place + 1
    if not len(name):
        return Anchors(name, doc, low, high)
    same = doc[1:] == doc[:-1]
    # Runs: what stands beside a run decides where it ends.
    begins = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | ~same])
    count = np.diff(np.r_[begins, len(name)])
    last = begins + count - 1
    first_of_doc = np.r_[True, ~same][begins]
    last_of_doc = np.r_[~same, True][last]
    low = np.where(first_of_doc, -FAR, place[begins] - 1)
    high = np.where(last_of_doc, FAR, place[last] + 2)
    name = np.where(count > 1, mix(name[begins], count.astype(np.uint64), 1), name[begins])
    doc = doc[begins]
    for number in range(rounds):
        right = (mix(name, name, 2 + number) >> np.uint64(17)) & np.uint64(1) == 1
        same = doc[1:] == doc[:-1]
        merged = same & ~right[:-1] & right[1:]
        into = np.r_[merged, False]
        gone = np.r_[False, merged]
        # The neighbour that a single symbol looked at: a left one to its right, a right one to its left.
        low_next = np.where(np.r_[same, False], np.r_[low[1:], 0], FAR)
        high_next = np.where(np.r_[same, False], np.r_[high[1:], 0], FAR)
        low_before = np.where(np.r_[False, same], np.r_[0, low[:-1]], -FAR)
        high_before = np.where(np.r_[False, same], np.r_[0, high[:-1]], -FAR)
        new_low = np.where(right, np.minimum(low, low_before), np.minimum(low, low_next))
        new_high = np.where(right, np.maximum(high, high_before), np.maximum(high, high_next))
        joined = np.r_[mix(name[:-1], name[1:], 3), np.uint64(0)]
        name = np.where(into, joined, name)[~gone]
        # A pair is decided by its parts; these are the same formulas as for a left single.
        low, high, doc = new_low[~gone], new_high[~gone], doc[~gone]
    if len(name) < 3:
        none = np.zeros(0, np.int64)
        return Anchors(none.view(np.uint64), none, none, none)
    inside = (doc[2:] == doc[:-2]) & (name[1:-1] < name[:-2]) & (name[1:-1] < name[2:])
    at = np.flatnonzero(inside) + 1
    return Anchors(
        mix(mix(name[at - 1], name[at], 4), name[at + 1], 5),
        doc[at],
        np.minimum(np.minimum(low[at - 1], low[at]), low[at + 1]),
        np.maximum(np.maximum(high[at - 1], high[at]), high[at + 1]),
    )


def window_names(names: np.ndarray, size: int, salt: int) -> np.ndarray:
    """A name for every window of ``size`` names, by doubling; windows may cross documents."""
    if len(names) < size:
        return np.zeros(0, np.uint64)
    count = len(names) - size + 1
    result, done, level, width = None, 0, mix(names, names, salt), 1
    while True:
        if size & width:
            part = level[done : done + count]
            result = part if result is None else mix(result, part, salt + 1)
            done += width
        if 2 * width > size:
            return result
        level = mix(level[:-width], level[width:], salt + 2)
        width *= 2
