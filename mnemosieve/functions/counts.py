"""Counts of a text's tokens inside a task."""

from __future__ import annotations

import re
from collections import Counter

from mnemosieve.functions.text import CJK

WORDS = re.compile(rb"[0-9a-z]{2,}")
CJK_RUNS = re.compile("[" + re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), CJK) + "]+")


def kind_of(token: bytes) -> bytes:
    """A token's kind, which its bytes tell: ASCII, or a CJK character (4 bytes at most), or two (6 at least)."""
    return b"a" if token[0] < 128 else b"u" if len(token) <= 4 else b"b"


def word_counts(text: bytes) -> Counter:
    """How often each token of functions.text.tokens occurs in a UTF-8 text."""
    found = Counter(WORDS.findall(text.lower()))
    if not text.isascii():
        for run in CJK_RUNS.findall(text.decode("utf-8", "replace")):
            found.update([run.encode()] if len(run) == 1 else [run[i : i + 2].encode() for i in range(len(run) - 1)])
    return found


def token_counts(text: str) -> Counter:
    """word_counts() of a string, each token after its kind."""
    return Counter({kind_of(k) + k: n for k, n in word_counts(text.encode("utf-8", "replace")).items()})
