"""What several of these operators need: Arrow passes over texts, hot-group joins, word hashes."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemosieve.sources.tables import read_table, scratch_path, written

__all__ = ["arrow_map", "attach_groups", "carried", "lower_ascii", "read_table", "released", "restored", "scale_floored", "scratch_path", "slices", "tree_sum", "valid_vector", "vector_rows", "worker_state", "written", "WordHasher"]

#: Rows of a batch that goes to Python, and bytes of text that a function sees at once.
BATCH_ROWS, SLICE_BYTES = 1000, 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def worker_state(name: str, make: Callable[[], object]) -> object:
    """Kept for the life of a Python worker, over its tasks."""
    kept = sys.modules.setdefault("mnemosieve_worker_state", types.ModuleType("mnemosieve_worker_state"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def give_back() -> None:
    """Returns freed memory to the system. A worker outlives its tasks, and several wait beside the JVM for their next one: what they hold then is nobody's use."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, and at its end give_back()."""
    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return both


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about `most` bytes together; a longer text comes alone."""
    sizes = np.diff(offsets_of(batch.column(column)))
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def offsets_of(text: pa.Array) -> np.ndarray:
    """Byte offsets of each text within the column's data."""
    kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
    return np.frombuffer(text.buffers()[1], kind)[text.offset : text.offset + len(text) + 1].astype(np.int64) if len(text) else np.zeros(1, np.int64)


def bytes_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after another, and where each begins (with the end as last)."""
    at = offsets_of(text)
    data = text.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def arrow_map(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema, column: str = "text") -> DataFrame:
    """function over slices of df; null texts come as empty ones. Memory is bounded by a slice, not by a partition."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                if (out := function(part)) is not None:
                    yield out

    return df.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit(""))).mapInArrow(released(run), schema)


def carried(docs: DataFrame, *columns: Column) -> DataFrame:
    """The given columns and `_own`, a struct of all columns of docs: whatever names they have, they clash with nothing."""
    return docs.select(*columns, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_own"))


def restored(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs out of `_own`."""
    return df.select(*(F.col("_own").getField(c).alias(c) for c in docs.columns))


def lower_ascii(column):
    """Lower-cases A-Z and nothing else."""
    return F.translate(column, UPPER, LOWER)


#: Rows of a group that stay together in a join at most.
TOGETHER = 1_000_000


def hot_limit(rows: int, groups: int = 2000) -> int:
    """Groups of more rows than this are hot; there are at most `groups` of them, whatever the input's size."""
    return max(1000, rows // groups)


def attach_groups(df: DataFrame, groups: DataFrame, keys: list[str], size: str, together: int = TOGETHER) -> DataFrame:
    """df with the columns of its group. Groups over the hot limit, of which at most 2000 can exist, are broadcast, so their rows stay
    where they are; the others are joined by a shuffle, in shares of about `together` rows of a key at most. groups has one row per key."""
    limit = hot_limit(groups.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0])
    hot, cold = groups.where(F.col(size) > limit), groups.where(F.col(size) <= limit)
    shares, by = -(-limit // together), keys
    if shares > 1:  # a key below the limit may still be more than a task should hold
        df, cold, by = df.withColumn("_share", F.pmod(F.monotonically_increasing_id(), F.lit(shares))), cold.withColumn("_share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long")))), [*keys, "_share"]
    if hot.isEmpty():
        return df.join(cold, by).drop("_share")
    marked = df.join(F.broadcast(hot.select(*keys, F.lit(True).alias("_hot"))), keys, "left")
    return (
        marked.where("_hot").drop("_hot").join(F.broadcast(hot.drop("_share")), keys)
        .unionByName(marked.where("_hot is null").drop("_hot").join(cold, by))
    ).drop("_share")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of the words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased, of a column of texts, without making strings of them.

    Two different words share a hash with a chance of about 2**-64 for each pair.
    """

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32
        self.space = np.zeros(256, bool)
        self.space[[32, *range(9, 14)]] = True
        self.power = np.ones(1, np.uint64)

    def powers(self, n: int) -> np.ndarray:
        if n > len(self.power):
            more = np.full(max(64, 2 * n), self.BASE, np.uint64)
            more[0] = 1
            self.power = np.cumprod(more, dtype=np.uint64)
        return self.power

    def words(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each word; its first and end byte; the number of the first word of each text (with the total as last); the folded bytes."""
        raw, at = bytes_of(text)
        raw = self.fold[raw]
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = ~self.space[raw]
        edge = np.zeros(len(raw) + 1, bool)  # where a text begins
        edge[at] = True
        start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        first = np.searchsorted(start, at)
        if not len(start):
            return np.zeros(0, np.uint64), start, end, first, raw
        return self.spans(raw, start, end), start, end, first, raw

    def spans(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from each start to its end; the spans don't overlap."""
        size = end - start
        power = self.powers(int(size.max()) + 1)
        total = int(size.sum())
        begins = np.cumsum(size) - size
        within = np.arange(total) - np.repeat(begins, size)
        value = (raw[np.repeat(start, size) + within].astype(np.uint64) + np.uint64(1)) * power[within]
        return mix64(np.add.reduceat(value, begins) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))



def valid_vector(vector: Column) -> Column:
    """Whether a vector has components, none of them null or non-finite."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))), F.lit(False))


def scale_floored(vector: Column, scale: int, most: float) -> Column:
    """floor(scale * x) of each component, as doubles that hold whole numbers, within +-most."""
    return F.transform(vector, lambda x: F.least(F.greatest(F.floor(F.least(F.greatest(x.cast("double") * float(scale), F.lit(-most)), F.lit(most))).cast("double"), F.lit(-most)), F.lit(most)))


def vector_rows(vectors: pa.Array) -> np.ndarray:
    """The lists of a column, all of one length and without nulls, as rows."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1)


def tree_sum(rows: DataFrame, of_batch: Callable[[pa.RecordBatch], np.ndarray], zero: np.ndarray) -> np.ndarray:
    """The sum of of_batch over all batches of rows: within a task, then over tasks by treeAggregate. An array of objects holds Python's integers, so is exact."""
    exact = zero.dtype == object

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = zero
        for batch in batches:
            if batch.num_rows:
                total = total + of_batch(batch)
        whole, real = ([str(v) for v in total.ravel()], []) if exact else ([], total.ravel().tolist())
        yield pa.RecordBatch.from_arrays([pa.array([whole], pa.list_(pa.string())), pa.array([real], pa.list_(pa.float64()))], ["whole", "real"])

    read = lambda r: np.array([int(v) for v in r["whole"]], object) if exact else np.array(r["real"])
    total = rows.mapInArrow(run, "whole array<string>, real array<double>").rdd.treeAggregate(zero.ravel(), lambda a, r: a + read(r), lambda a, b: a + b)
    return total.reshape(zero.shape)
