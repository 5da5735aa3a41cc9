"""BPE encoding by dynamic programming over prefixes, and decoding.

The tokens that end at each position of a word come from an automaton of the vocabulary
with suffix links.  A prefix's encoding is that of a shorter prefix plus one token, and its
last token is unique: it is the one that is compatible with the last token of the prefix
before it.  One token per prefix is stored; following them back gives the ids.  Two tokens
are compatible if the merges, in rank order, leave the seam between them alone.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from eventloom.llm.base import INFORMATION_SEPARATORS, Memo, arrays, documents, id_and_text, remembers, turn_of

VOCABULARY = "word_bpe_49k.json"
#: Entries that a task remembers: of text between white space, of words, of token pairs.
REMEMBERED = 500_000
#: A word's last symbol stands this far above its plain form.
_FINAL = 0x1000
_NEVER = 1 << 60


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself
    where it is printable and not blank in Latin-1, else the next one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class BpeVocabulary:
    """Encoder and decoder for a vocabulary with word ends, lower case and no white space."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        end = model["end_of_word_suffix"]
        self.names: dict[int, str] = {i: s for s, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.names |= {i: s for s, i in self.special.items()}
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        spelled = {}
        symbols = byte_symbols()
        for c in symbols:
            spelled[model["vocab"][c]] = c
            spelled[model["vocab"][c + end]] = chr(ord(c) + _FINAL)
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, made = (model["vocab"][x] for x in (left, right, left + right))
            self.merged.setdefault((a, b), rank)
            if made not in self.parts:
                self.parts[made], self.rank[made] = (a, b), rank
                spelled[made] = spelled[a] + spelled[b]
        self.automaton = ahocorasick.Automaton()
        for token, word in spelled.items():
            self.automaton.add_word(word, (token, len(word)))
        self.automaton.make_automaton()
        self.symbols = {b: c for b, c in enumerate(symbols) if chr(b) != c}
        self.pretoken = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
        )
        self.ascii_words = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall
        self.blanks = regex.compile(r"\p{White_Space}+")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.compatible = Memo(self._compatible, 2 * REMEMBERED)
        self.stable = Memo(self._stable, 1 << 20)
        self.word = Memo(self._encode_word, REMEMBERED)

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Whether the text of the two tokens is encoded as these two.

        Inside a token, the symbol at the seam is merged into larger and larger parts, each
        at its rank.  Both sides are followed in rank order; the seam breaks if two parts
        that meet there have a merge that comes before either is merged on its own side.
        Of equal ranks the merge further left comes first.
        """
        left, right = [pair[0]], [pair[1]]
        while left[-1] in self.parts:
            left.append(self.parts[left[-1]][1])
        while right[-1] in self.parts:
            right.append(self.parts[right[-1]][0])
        while True:
            next_left = self.rank[left[-2]] if len(left) > 1 else _NEVER
            next_right = self.rank[right[-2]] if len(right) > 1 else _NEVER
            meeting = self.merged.get((left[-1], right[-1]), _NEVER)
            if meeting < next_left and meeting <= next_right and meeting != _NEVER:
                return False
            if next_left == next_right == _NEVER:
                return True
            (left if next_left <= next_right else right).pop()

    def _stable(self, token: int) -> bool:
        """Whether the token's own text is encoded as this token alone: its parts are, and
        nothing but its last merge touches the seam between them."""
        if token not in self.parts:
            return True
        a, b = self.parts[token]
        if not (self.stable[a] and self.stable[b]):
            return False
        merge = self.merged.pop((a, b))
        try:
            return self._compatible((a, b))
        finally:
            self.merged[a, b] = merge

    def _encode_word(self, word: str) -> tuple[int, ...]:
        symbols = word.encode("utf-8").decode("latin-1").translate(self.symbols)
        return tuple(self.prefix_tokens(symbols[:-1] + chr(ord(symbols[-1]) + _FINAL)))

    def prefix_tokens(self, symbols: str) -> list[int]:
        """Ids of one word, given its symbols, the last one in its final form."""
        size = len(symbols)
        # Last token of each prefix, and where it begins; -1: not found yet.
        last, begin = [-1] * (size + 1), [0] * (size + 1)
        compatible, stable = self.compatible, self.stable
        for at, (token, length) in self.automaton.iter(symbols):
            end = at + 1
            if last[end] < 0:
                start = end - length
                if (not start or (last[start] >= 0 and compatible[last[start], token])) and stable[token]:
                    last[end], begin[end] = token, start
        ids, at = [], size
        while at:
            ids.append(last[at])
            at = begin[at]
        ids.reverse()
        return ids

    def encode_unit(self, unit: str) -> list[int]:
        """Ids of text without white space.  Special tokens keep their own ids."""
        ids: list[int] = []
        if unit.isascii() and "<|" not in unit:
            for word in self.ascii_words(unit.lower()):
                ids += self.word[word]
            return ids
        for part in self.specials.split(unit):
            if part in self.special:
                ids.append(self.special[part])
                continue
            part = unicodedata.normalize("NFC", part)
            # Letter by letter, so that a capital sigma has one lower form everywhere.
            part = "".join(map(str.lower, part)) if "Σ" in part else part.lower()
            for word in self.pretoken.findall(part):
                ids += self.word[word]
        return ids

    def units(self, text: str) -> list[str]:
        """Text between white space: no token spans it, so units are encoded apart."""
        if any(c in text for c in INFORMATION_SEPARATORS):
            return [u for u in self.blanks.split(text) if u]
        return text.split()

    def encode(self, text: str) -> list[int]:
        return [i for u in self.units(text) for i in self.encode_unit(u)]

    def decode(self, ids: Iterable[int]) -> str:
        """The vocabulary names no decoder: token strings joined by blanks."""
        return " ".join(map(self.names.__getitem__, ids))


class Digester:
    """Per text: number of ids, digest of the ids, digest of the decoded text."""

    def __init__(self, path: str):
        self.bpe = BpeVocabulary(path)
        self.memo = Memo(self._unit, REMEMBERED)

    def _unit(self, unit: str) -> tuple[int, str, str]:
        ids = self.bpe.encode_unit(unit)
        return len(ids), " ".join(map(str, ids)), self.bpe.decode(ids)

    def __call__(self, text: str) -> tuple[int, str, str]:
        units = list(map(self.memo.__getitem__, self.bpe.units(text)))
        ids = " ".join([u[1] for u in units])
        decoded = " ".join([u[2] for u in units])
        return sum([u[0] for u in units]), _sha256(ids), _sha256(decoded)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


@functools.cache
def digester(name: str) -> Digester:
    """One for each Python worker."""
    import public_tokenizers

    return Digester(public_tokenizers.path(name))


remembers("bpe", digester.cache_clear)


def encode_documents(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """``doc_id, ids``: the ids themselves, for those who store them."""

    def encoded(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn_of("bpe")
        bpe = digester(name).bpe
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": [bpe.encode(t) for t in frame["text"]]})

    return id_and_text(docs).mapInPandas(encoded, "doc_id long, ids array<int>")


def digest_documents(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """One row per document, without a shuffle.

    A null text is empty: no ids, digests of the empty string.  Repeated rows and null ids
    stay; further columns are ignored.  The memories of words are bounded, so a task needs
    no more memory for long texts than the texts themselves take.
    """

    def digested(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn_of("bpe")
        digest = digester(name)
        for frame in frames:
            rows = [(doc, *digest(text)) for doc, text in arrays([frame], "doc_id", "text")]
            out = pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            yield out.astype({"doc_id": "Int64"})

    return id_and_text(docs).mapInPandas(
        digested, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op6_bpe_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(documents(spark, sf_dir))
