"""BERT-style word pieces: normalise, split, greedy longest match, encode. An Arrow UDF over a broadcast vocabulary.

Normalising and splitting are one translation of the text: a table tells for each code point what it becomes (nothing, a blank, itself, or itself between
blanks), so both run at the speed of str.translate. A word is matched once by a worker and remembered.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MAX_LENGTH, LONGEST_WORD, PREFIX = 512, 100, "##"
#: Words that a worker remembers.
REMEMBERED = 200_000
# Blocks whose characters stand alone.
CHINESE = ((0x4E00, 0x9FFF), (0x3400, 0x4DBF), (0x20000, 0x2A6DF), (0x2A700, 0x2B73F), (0x2B740, 0x2B81F), (0x2B820, 0x2CEAF), (0xF900, 0xFAFF), (0x2F800, 0x2FA1F))


def is_punctuation(c: str) -> bool:
    return unicodedata.category(c)[0] == "P" or c.isascii() and c.isprintable() and not c.isalnum() and c != " "


class Cleaning(dict):
    """For str.translate: controls go (unassigned code points stay), white space becomes a blank, Chinese characters get blanks around them."""

    def __missing__(self, point: int) -> str | None:
        self[point] = found = self.of(point)
        return found

    def of(self, point: int) -> str | None:
        c, kind = chr(point), unicodedata.category(chr(point))
        if c in "\t\n\r":
            return " "
        if point in (0, 0xFFFD) or kind in ("Cc", "Cf", "Co", "Cs"):
            return None
        if kind in ("Zs", "Zl", "Zp"):
            return " "
        return f" {c} " if any(a <= point <= b for a, b in CHINESE) else c


class Splitting(Cleaning):
    """Cleaning, and blanks around punctuation: what lies between blanks is a word."""

    def of(self, point: int) -> str | None:
        found = super().of(point)
        return f" {found} " if found is not None and len(found) == 1 and is_punctuation(found) else found


CLEANING, SPLITTING = Cleaning(), Splitting()


@dataclass(frozen=True)
class WordPiece:
    """A vocabulary and its special tokens."""

    vocab: dict[str, int]
    lower: bool = False
    prefix: str = PREFIX
    longest: int = LONGEST_WORD
    cls: str = "[CLS]"
    sep: str = "[SEP]"
    unk: str = "[UNK]"
    _known: dict = field(default_factory=dict, repr=False, compare=False)

    def __post_init__(self) -> None:
        for token in (self.cls, self.sep, self.unk):
            if token not in self.vocab:
                raise ValueError(f"the vocabulary lacks {token}")

    @classmethod
    def from_json(cls, text: str) -> WordPiece:
        """The model of a tokenizer file, with the names and limits it tells."""
        told = json.loads(text)
        model, special = told["model"], (told.get("post_processor") or {}).get("special_tokens") or {}
        name = lambda x: (special.get(x) or {}).get("id", x)
        longest = model.get("max_input_chars_per_word")
        return cls(
            dict(model["vocab"]), bool((told.get("normalizer") or {}).get("lowercase")), model.get("continuing_subword_prefix") or PREFIX,
            LONGEST_WORD if longest is None else int(longest), name("[CLS]"), name("[SEP]"), model.get("unk_token") or "[UNK]",
        )

    def normalized(self, text: str) -> str:
        """Controls dropped, white space made blanks, Chinese characters padded."""
        out = text.translate(CLEANING)
        return out.lower() if self.lower else out

    def words(self, text: str) -> Iterator[str]:
        """Words of a text: split at blanks, punctuation alone."""
        out = text.translate(SPLITTING)
        return filter(None, (out.lower() if self.lower else out).split(" "))

    def pieces(self, word: str) -> tuple[int, ...]:
        """The longest piece from each place on; one unknown for a word that has no pieces or is too long."""
        found = self._known.get(word)
        if found is None:
            found = self._matched(word)
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            self._known[word] = found
        return found

    def _matched(self, word: str) -> tuple[int, ...]:
        if len(word) > self.longest:
            return (self.vocab[self.unk],)
        out, at = [], 0
        while at < len(word):
            for end in range(len(word), at, -1):
                piece = self.vocab.get(word[at:end] if at == 0 else self.prefix + word[at:end])
                if piece is not None:
                    out.append(piece)
                    at = end
                    break
            else:
                return (self.vocab[self.unk],)
        return tuple(out)

    def encode(self, text: str, max_length: int = MAX_LENGTH) -> list[int]:
        """The first token, the pieces, the last token; cut so that the last stays."""
        ids = [self.vocab[self.cls]]
        for word in self.words(text):
            ids += self.pieces(word)
            if len(ids) >= max_length:
                break
        return [*ids[: max_length - 1], self.vocab[self.sep]]


def from_word_ends(path: str, end: str = "</w>") -> WordPiece:
    """A model whose pieces are the entries of a tokenizer file with word ends: an entry, with or without its end, begins a word and continues one."""
    with open(path, encoding="utf-8") as f:
        entries = sorted(json.load(f)["model"]["vocab"].items(), key=lambda x: x[1])
    told = dict.fromkeys(["[UNK]", "[CLS]", "[SEP]"])
    for entry, _ in entries:
        if piece := entry.removesuffix(end):
            told[piece] = told[PREFIX + piece] = None
    return WordPiece({piece: i for i, piece in enumerate(told)}, lower=True)


def encode(text: Column, model: WordPiece, max_length: int = MAX_LENGTH) -> Column:
    """array<int>. A null text counts as empty. The vocabulary is broadcast once a query."""
    sent = SparkSession.active().sparkContext.broadcast(model)

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        told = sent.value
        for texts in batches:
            yield texts.fillna("").map(lambda x: told.encode(x, max_length))

    return run(text)
