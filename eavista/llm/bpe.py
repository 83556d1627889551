"""Byte-pair encoding and decoding with the vocabulary of a public tokenizer file.

Encoding never applies merges one by one. An Aho-Corasick automaton finds the longest token that
starts at every place of a word; the encoder takes the longest one, checks that it may follow the
token before it, tries the next shorter one if not, and steps back when none fits. Two tokens are
compatible when no merge of the file could have joined the inner ends of their merge trees before
the trees were complete; a sequence whose neighbours are all compatible is the one that merging
gives, and every prefix has only one such sequence, so a place that failed once is never tried again
and the work is linear. Decoding copies slices of one array of all token texts by an offset table.

Defined cases: a null text is empty and has no tokens; special-token strings inside a text are
special tokens, as in the tokenizers library; repeated rows are encoded alike. Tables are as large
as the vocabulary file; the caches of words and pairs are cleared at a fixed size.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eavista.llm.common import small_batches, whole_text

VOCABULARY = "word_bpe_49k.json"
CACHED_WORDS, CACHED_PAIRS = 400_000, 1_000_000
#: The file's split pattern, with white space spelled out.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^\p{{White_Space}}{L}{N}]+"
PIECES = regex.compile(SPLIT.format(L=r"\p{L}", N=r"\p{N}"))
#: Added to the code of a word's last byte.
LAST = 0x1000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + extra)
            extra += 1
    return [letters[b] for b in range(256)]


#: Code points that the regex library's newer Unicode counts as letters or numbers
#: and the tokenizers library does not.
NEWER_LETTERS = (
    "\\u0558\\u058b-\\u058c\\u088f\\u0c5c\\u0cdc\\u208f\\u209d-\\u209f\\ua7ce-\\ua7cf\\ua7d2\\ua7d4\\ua7dd\\ua7e2"
    "\\ua7f1\\uab6c-\\uab6d\\U000107bb-\\U000107bf\\U00010940-\\U00010959\\U00010ec5-\\U00010ec7"
    "\\U00010ed9-\\U00010eee\\U00011b0a\\U00011db0-\\U00011ddb\\U00011df1\\U00016ea0-\\U00016eb8"
    "\\U00016ebb-\\U00016ed3\\U00016ff2-\\U00016ff3\\U000187f8-\\U000187ff\\U00018cd6-\\U00018cda"
    "\\U00018d09-\\U00018d20\\U00018d80-\\U00018df2\\U00018e00-\\U00019191\\U000191a0-\\U000191d2"
    "\\U0001b123-\\U0001b128\\U0001b168\\U0001d6a6\\U0001df1f-\\U0001df24\\U0001df2b-\\U0001df81"
    "\\U0001df90-\\U0001df96\\U0001dfcd-\\U0001dfff\\U0001e6c0-\\U0001e6de\\U0001e6e0-\\U0001e6e2"
    "\\U0001e6e4-\\U0001e6e5\\U0001e6e7-\\U0001e6ed\\U0001e6f0-\\U0001e6f4\\U0001e6fe-\\U0001e6ff"
    "\\U0002b73a-\\U0002b73f\\U0002b81e\\U0002cea2-\\U0002cead\\U000323b0-\\U00033479\\U0003d000-\\U0003fc3f"
    "\\U00011de0-\\U00011de9\\U0001246f\\U00012475-\\U0001247f\\U00012550-\\U00012686\\U00016ff4-\\U00016ff6"
)
#: Lower-case letters that the tokenizers library knows and this Python does not.
NEWER_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{upper: upper + 32 for upper in range(0x10D50, 0x10D66)},
    **{upper: upper + 27 for upper in range(0x16EA0, 0x16EB9)},
}
_NEWER = regex.compile("[" + NEWER_LETTERS + "]")
_NEWER_UPPER = regex.compile("[" + "".join(map(chr, NEWER_LOWER)) + "]")
_OLDER_PIECES = regex.compile(
    r"(?V1)" + SPLIT.format(L=rf"[\p{{L}}--{_NEWER.pattern}]", N=rf"[\p{{N}}--{_NEWER.pattern}]")
)


def _latin_class(kind: str) -> str:
    """The characters below U+0250 whose general category begins with a letter, as the inside of a class."""
    return "".join(re.escape(chr(i)) for i in range(0x250) if unicodedata.category(chr(i))[0] == kind)


#: The same pattern for texts below U+0250, by the faster module: its alternatives begin differently, so their
#: order is free.
_LATIN_PIECES = re.compile(
    "[{L}]+|[{N}]|'(?:s|t|re|ve|m|ll|d)|[^\t-\r \x85\xa0{L}{N}]+".format(L=_latin_class("L"), N=_latin_class("N"))
)
_ASCII_PIECES = re.compile("[a-zA-Z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\t-\r a-zA-Z0-9]+")
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")


def lowered(text: str) -> str:
    """The normalised text; letter by letter, so a last sigma is no exception."""
    text = unicodedata.normalize("NFC", text)
    if text.isascii():
        return text.lower()
    if _NEWER_UPPER.search(text):
        text = text.translate(NEWER_LOWER)
    return text.replace("Σ", "σ").lower()


def pieces(text: str) -> list[str]:
    """The words of a text in lower case, by the file's split pattern."""
    if text.isascii():
        return _ASCII_PIECES.findall(text)
    if not _BEYOND_LATIN.search(text):
        return _LATIN_PIECES.findall(text)
    return (_OLDER_PIECES if _NEWER.search(text) else PIECES).findall(text)


class OffsetTable:
    """Texts of all tokens in one array, each with a space behind it, and where they begin."""

    def __init__(self, texts: Iterable[str]):
        encoded = [t.encode() + b" " for t in texts]
        self.blob = np.frombuffer(b"".join(encoded), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in encoded])])
        self.sizes = np.diff(self.offsets)

    def slices(self, ids: np.ndarray) -> Iterator[bytes]:
        """The texts of the tokens joined by spaces, in parts of bounded size."""
        for at in range(0, len(ids), 1 << 16):
            chosen = ids[at : at + (1 << 16)]
            size = self.sizes[chosen]
            ends = np.cumsum(size)
            places = np.arange(ends[-1]) + np.repeat(self.offsets[chosen] - (ends - size), size)
            part = self.blob[places].tobytes()
            yield part if at + (1 << 16) < len(ids) else part[:-1]

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(self.slices(ids))


class Vocabulary:
    """Plain tables read from a vocabulary file; small and fixed, so they can be sent to every task."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.suffix: str = model["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in content["added_tokens"]}


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        ids = vocabulary.ids
        size = 1 + max([*ids.values(), *vocabulary.specials.values()])
        self.left, self.right = [-1] * size, [-1] * size
        self.rank, self.length, self.shorter = [-1] * size, [0] * size, [-1] * size
        self.pair_rank: dict[tuple[int, int], int] = {}
        spelled: dict[int, str] = {}
        for byte, letter in enumerate(byte_letters()):
            spelled[ids[letter]] = chr(byte)
            spelled[ids[letter + vocabulary.suffix]] = chr(byte + LAST)
        for rank, (a, b) in enumerate(vocabulary.merges):
            left, right, token = ids[a], ids[b], ids[a + b]
            self.pair_rank[left, right] = rank
            if token not in spelled:
                self.left[token], self.right[token], self.rank[token] = left, right, rank
                spelled[token] = spelled[left] + spelled[right]
        self.pairs: dict[tuple[int, int], bool] = {}
        by_spelling = {}
        for token, text in spelled.items():
            left, right = self.left[token], self.right[token]
            if left < 0 or (
                by_spelling.get(spelled[left]) == left and by_spelling.get(spelled[right]) == right
                and self.compatible(left, right, below=self.rank[token])
            ):
                by_spelling[text] = token
        self.finder = ahocorasick.Automaton()
        for text, token in by_spelling.items():
            self.length[token] = len(text)
            self.finder.add_word(text, token)
            prefixes = (by_spelling.get(text[:k]) for k in range(len(text) - 1, 0, -1))
            self.shorter[token] = next((p for p in prefixes if p is not None), -1)
        self.finder.make_automaton()
        self.special_ids = vocabulary.specials
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.specials)) or "(?!)")
        texts = [""] * size
        for text, token in [*ids.items(), *vocabulary.specials.items()]:
            texts[token] = text
        self.texts, self.decimals = OffsetTable(texts), OffsetTable(map(str, range(size)))
        self.words = Words(self.word_ids)

    def compatible(self, first: int, second: int, below: int | None = None) -> bool:
        """May ``second`` follow ``first`` unmerged? With ``below``: until the merge of that rank."""
        x, y = first, second
        x_until = y_until = len(self.pair_rank) if below is None else below
        while True:
            rank = self.pair_rank.get((x, y))
            if rank is not None and rank < x_until and rank <= y_until:
                return False
            if self.rank[x] < 0 and self.rank[y] < 0:
                return True
            if self.rank[x] > self.rank[y]:
                x_until, x = self.rank[x], self.right[x]
            else:
                y_until, y = self.rank[y], self.left[y]

    def follows(self, first: int, second: int) -> bool:
        known = self.pairs.get((first, second))
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[first, second] = self.compatible(first, second)
        return known

    def word_ids(self, word: str) -> list[int]:
        """Ids of one word of the split text.

        The automaton gives the longest token at a place and goes on behind it, as long as these
        tokens fit; elsewhere it is asked anew. Every byte is a token, so there always is one.
        """
        data = word.encode()
        spelled = data[:-1].decode("latin-1") + chr(data[-1] + LAST)
        longest, length, shorter, follows = self.finder.iter_long, self.length, self.shorter, self.follows
        size, place, found = len(spelled), 0, []
        failed = bytearray(size + 1)
        matches = longest(spelled)
        token = offered = next(matches)[1]
        while place < size:
            while token >= 0 and (failed[place + length[token]] or found and not follows(found[-1], token)):
                token = shorter[token]
            if token >= 0:
                found.append(token)
                place += length[token]
                if place < size:
                    if token != offered:
                        matches = longest(spelled, place)
                    token = offered = next(matches)[1]
            else:
                failed[place] = 1
                last = found.pop()
                place -= length[last]
                token, offered = shorter[last], -1
        return found

    def encoded(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        found, done = [], 0
        for match in self.special.finditer(text):
            found += map(self.words.__getitem__, pieces(lowered(text[done : match.start()])))
            found.append(np.int32(self.special_ids[match.group()]).tobytes())
            done = match.end()
        found += map(self.words.__getitem__, pieces(lowered(text[done:] if done else text)))
        return np.frombuffer(b"".join(found), np.int32)

    def encode(self, text: str) -> list[int]:
        return self.encoded(text).tolist()

    def decode(self, ids: Sequence[int]) -> str:
        """Token texts joined by a space."""
        return self.texts.joined(np.asarray(ids, np.int64)).decode()


class Words(dict):
    """Ids of words as bytes of 32-bit numbers, made when they are first asked for."""

    def __init__(self, make: Callable[[str], list[int]]):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        made = np.array(self.make(word), np.int32).tobytes()
        if len(word) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = made
        return made


_codecs: dict[str, Codec] = {}


def _codec(name: str, vocabulary: Vocabulary) -> Codec:
    """One codec for each Python worker and vocabulary."""
    if name not in _codecs:
        _codecs[name] = Codec(vocabulary)
    return _codecs[name]


def encoder(spark: SparkSession, path: str):
    """A column function from text to token ids."""
    shared = spark.sparkContext.broadcast(Vocabulary(path))

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(path, shared.value)
        for texts in batches:
            yield texts.map(lambda t: codec.encode(t or ""))

    return encode


def decoder(spark: SparkSession, path: str):
    """A column function from token ids to text."""
    shared = spark.sparkContext.broadcast(Vocabulary(path))

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(path, shared.value)
        for ids in batches:
            yield ids.map(lambda i: codec.decode([] if i is None else list(i)))

    return decode


def _sha256(parts: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part)
    return digest.hexdigest()


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>"


def digest(spark: SparkSession, path: str, with_ids: bool = False):
    """A column function from text to its ids and the digests of the ids and of the text decoded from them."""
    shared = spark.sparkContext.broadcast(Vocabulary(path))

    @F.pandas_udf(DIGEST)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(path, shared.value)
        for texts in batches:
            rows = []
            for text in texts:
                ids = codec.encoded(text)
                rows.append((
                    len(ids), _sha256(codec.decimals.slices(ids)), _sha256(codec.texts.slices(ids)), ids if with_ids else None,
                ))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "ids"])

    return run


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text for every row."""
    small_batches(docs.sparkSession)
    run = digest(docs.sparkSession, path or vocabulary_path())
    found = docs.select(docs["doc_id"].alias("doc_id"), run(whole_text(docs)).alias("d"))
    return found.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")


def tokenized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids and the digest of the text decoded from them, for every row."""
    small_batches(docs.sparkSession)
    run = digest(docs.sparkSession, path or vocabulary_path(), with_ids=True)
    found = docs.select(docs["doc_id"].alias("doc_id"), run(whole_text(docs)).alias("d"))
    return found.select("doc_id", "d.n_tokens", "d.ids", "d.decoded_sha256")
