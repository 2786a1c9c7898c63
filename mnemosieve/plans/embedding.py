"""Embedders that work batch by batch: texts in slices through Arrow, their count reported as tasks finish."""

from __future__ import annotations

import hashlib
import re
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Texts that a model sees at once, and seconds between two looks at the count.
SLICE, LOOK = 32, 0.2


@dataclass
class BatchEmbedder:
    """A model that turns a list of texts into vectors. function: texts to an array of texts x dimension; it is shipped to the tasks and may load what it
    needs there. A text's vector doesn't depend on its slice: that is the function's contract, and `slice` changes nothing but speed and memory.

    A wrong number or length of vectors, or one that isn't finite, fails the task and so the sync; nothing is committed then. Vectors are brought to
    unit length, with sums of squares in 64 bits; a zero vector stays zero. A null text counts as empty."""

    spark: SparkSession
    function: Callable[[list[str]], np.ndarray]
    dimension: int
    identity: str
    slice: int = SLICE
    done: object = field(init=False, repr=False)

    def __post_init__(self) -> None:
        if self.slice < 1:
            raise ValueError("a slice has at least one text")
        self.done = self.spark.sparkContext.accumulator(0)

    def embed(self, text: Column) -> Column:
        function, dimension, size, done = self.function, self.dimension, self.slice, self.done

        @F.pandas_udf("array<float>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                texts, out = batch.fillna("").tolist(), []
                for at in range(0, len(texts), size):
                    some = texts[at : at + size]
                    out += list(unit_rows(function(some), len(some), dimension))
                    done.add(len(some))
                yield pd.Series(out, dtype=object)

        return run(text)


def unit_rows(vectors: np.ndarray, count: int, dimension: int) -> np.ndarray:
    """Checked vectors of unit length in 32 bits."""
    wide = np.asarray(vectors, np.float64)
    if wide.shape != (count, dimension):
        raise ValueError(f"the model gave {wide.shape} for {count} texts of dimension {dimension}")
    if not np.isfinite(wide).all():
        raise ValueError("the model gave a vector that isn't finite")
    return (wide / np.maximum(np.sqrt((wide**2).sum(1, keepdims=True)), 1e-12)).astype(np.float32)


@dataclass(frozen=True)
class HashedWords:
    """Counts of words, each added or subtracted at the place its MD5 names: texts that share words point the same way. Exact, and needs no model file."""

    dimension: int = 64

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension))
        for row, text in zip(out, texts, strict=True):
            for word in re.findall(r"[0-9A-Za-z\u00C0-\u024F\u4E00-\u9FFF]+", text):
                digest = hashlib.md5(word.encode()).hexdigest()
                row[int(digest[:7], 16) % self.dimension] += 1 if int(digest[7], 16) % 2 else -1
        return out


def hashed_words(spark: SparkSession, dimension: int = 64, slice: int = SLICE) -> BatchEmbedder:
    return BatchEmbedder(spark, HashedWords(dimension), dimension, f"words-{dimension}", slice)


@contextmanager
def watched(embedder: object, total: int, on_progress: Callable[[int, int], None] | None):
    """Calls on_progress(embedded, total) whenever more texts are known to be embedded, and at the end. Tasks report when they finish; a repeated task
    counts again, but never beyond total. An embedder that doesn't count reports once, at the end."""
    if on_progress is None:
        yield
        return
    counter = getattr(embedder, "done", None)
    start, stop, last = counter.value if counter is not None else 0, threading.Event(), 0

    def look() -> None:
        nonlocal last
        while counter is not None and not stop.wait(LOOK):
            if (now := min(total, counter.value - start)) > last:
                last = now
                on_progress(now, total)

    thread = threading.Thread(target=look, daemon=True)
    thread.start()
    try:
        yield
    finally:
        stop.set()
        thread.join()
    on_progress(total, total)
