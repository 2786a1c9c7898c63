"""Byte-level BPE by two tiers: a minimal perfect hash for whole pre-tokens of the vocabulary, a heap over linked bytes for the others.

A text is split into pre-tokens (below) over arrays of code points. The distinct pre-tokens of a slice are looked up together: hash, bucket, displacement,
slot, and a comparison of bytes, since a pre-token outside the vocabulary has a slot too. What isn't found is merged: its bytes are a linked list,
a heap holds the pairs that the vocabulary knows by rank and place, and the least is merged until none is left. Merged pre-tokens are remembered by a
worker, up to a number of them. The vocabulary (tables of some MB, bounded by the rank file) is read by the driver and broadcast.

Pre-tokens are the matches of public_tokenizers.PATTERN: contractions, words, numbers and other signs, each with a space before it, and runs of white
space, of which the last character is left to what follows. Code points are letters, numbers or white space as tiktoken's own engine has it.

Defined results: a null text counts as empty and gives no ids; repeated rows are encoded each; bytes that aren't UTF-8 count as U+FFFD; further columns are
carried along; an empty table gives an empty table. A text beyond WINDOW code points is split window by window, each from the start of a pre-token,
so memory follows the window and the longest pre-token. Two different pre-tokens of one slice share a 64-bit hash with a chance of about 2**-64.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from mnemosieve.llm.common import WordHasher, arrow_map, bytes_of, mix64, read_table, worker_state

#: Code points of a window of a long text; merged pre-tokens that a worker remembers, and bytes of one at most.
WINDOW, REMEMBERED, REMEMBERED_BYTES = 1 << 20, 400_000, 64
#: Keys in a bucket on average; displacements tried at once.
BUCKET, TRIES = 4, 512
LETTER, NUMBER, SPACE, OTHER = range(4)
CODE_POINTS = 0x110000
STEP = np.uint64(0x9E3779B97F4A7C15)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size in turn."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes; none is empty."""
    return worker_state("bpe_hasher", WordHasher).spans(raw, start, end) if len(start) else np.zeros(0, np.uint64)


def displaced(h: np.ndarray, by: np.ndarray, n: int) -> np.ndarray:
    return (mix64(h ^ (by.astype(np.uint64) * STEP)) % np.uint64(n)).astype(np.int64)


def displacements(h: np.ndarray) -> np.ndarray:
    """For each bucket of the keys (distinct hashes) a number that sends them to slots of their own, all n slots together; -1 - slot for a bucket of one key."""
    n = len(h)
    buckets = max(1, -(-n // BUCKET))
    bucket = (mix64(h) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    first = np.searchsorted(bucket[order], np.arange(buckets + 1))
    sizes = np.diff(first)
    by, free = np.zeros(buckets, np.int64), np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        own = h[order[first[b] : first[b + 1]]]
        if len(own) < 2:
            break
        at = 0
        while True:
            slots = np.sort(displaced(own[None], np.arange(at, at + TRIES)[:, None], n), 1)
            fits = free[slots].all(1) & (np.diff(slots, axis=1) > 0).all(1)
            if fits.any():
                by[b] = at + int(np.argmax(fits))
                free[slots[int(np.argmax(fits))]] = False
                break
            at += TRIES
    alone = np.flatnonzero(sizes == 1)
    by[alone] = -1 - np.flatnonzero(free)[: len(alone)]
    return by


@dataclass
class Vocabulary:
    """Tables of a rank file. kinds: the class of each code point; by: displacements; slot: rank of each slot; raw, at: the bytes of each rank."""

    kinds: np.ndarray
    by: np.ndarray
    slot: np.ndarray
    raw: np.ndarray
    at: np.ndarray

    def ranks_of(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The rank of each span of bytes that is in the vocabulary as a whole, else -1."""
        by = self.by[(mix64(h) % np.uint64(len(self.by))).astype(np.int64)]
        rank = self.slot[np.where(by < 0, -1 - by, displaced(h, np.maximum(by, 0), len(self.slot)))]
        size = end - start
        same = np.flatnonzero(self.at[rank + 1] - self.at[rank] == size)
        found = np.full(len(h), -1, np.int64)
        if len(same):
            n, inside = size[same], within(size[same])
            equal = raw[np.repeat(start[same], n) + inside] == self.raw[np.repeat(self.at[rank[same]], n) + inside]
            same = same[np.logical_and.reduceat(equal, np.cumsum(n) - n)]
            found[same] = rank[same]
        return found

    def merges(self) -> dict[bytes, int]:
        raw = self.raw.tobytes()
        return {raw[a:b]: i for i, (a, b) in enumerate(zip(self.at[:-1], self.at[1:], strict=True))}


def code_point_kinds() -> np.ndarray:
    """Letter, number, white space or other, for each code point. Points that this Python's tables don't know yet are put to tiktoken's engine."""
    import regex
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    everything = "".join(chr(c) for c in range(CODE_POINTS) if not 0xD800 <= c < 0xE000)
    kinds = np.full(CODE_POINTS, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        engine = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        for c in regex.findall(pattern, everything):
            if unicodedata.category(c) != "Cn" or engine.encode_ordinary(c):
                kinds[ord(c)] = kind
    return kinds


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Tables of a file of base64 byte strings and ranks from 0 on without gaps; every single byte has a rank."""
    with open(path, "rb") as f:
        known = sorted((int(rank), base64.b64decode(word)) for word, rank in map(bytes.split, filter(bytes.strip, f)))
    if [r for r, _ in known] != list(range(len(known))) or len({w for _, w in known if len(w) == 1}) != 256:
        raise ValueError(f"{path}: ranks must go from 0 on without gaps and cover every byte")
    raw, at = np.frombuffer(b"".join(w for _, w in known), np.uint8), np.cumsum([0, *(len(w) for _, w in known)])
    h = hashes(raw, at[:-1], at[1:])
    if len(np.unique(h)) < len(h):
        raise ValueError(f"{path}: two entries are equal")
    by = displacements(h)
    own = by[(mix64(h) % np.uint64(len(by))).astype(np.int64)]
    slot = np.zeros(len(h), np.int64)
    slot[np.where(own < 0, -1 - own, displaced(h, np.maximum(own, 0), len(h)))] = np.arange(len(h))
    return Vocabulary(code_point_kinds(), by, slot, raw, at)


def pretokens(points: np.ndarray, first: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in code points of texts one after another; first: where each text begins, with the total as last."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = kinds[points]
    text = np.zeros(n + 1, bool)
    text[first] = True
    begins = text[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(begins)
    ends = np.append(runs[1:], n)
    space = (kind[runs] == SPACE) & ~text[ends]  # white space with something after it: its last character stands alone or goes with what follows
    last = ends[space] - 1
    begins[last] = True
    begins[last[points[last] == 32] + 1] = False
    mark = runs[(points[runs] == 39) & (ends == runs + 1) & ~text[ends]]  # an apostrophe alone, with letters after it
    mark = mark[begins[mark] & (kind[np.minimum(mark + 1, n - 1)] == LETTER)]
    if len(mark):
        one = points[mark + 1]
        two = np.where(text[np.minimum(mark + 2, n)], 0, points[np.minimum(mark + 2, n - 1)])
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, np.where(pair, 2, 0))
        mark, size = mark[size > 0], size[size > 0]
        begins[mark + 1] = False
        after = mark + 1 + size
        begins[after[after < n]] = True
    return np.flatnonzero(begins)


def merged(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of a pre-token: the pair of the least rank is merged, the leftmost of them first."""
    n, get, pop, push = len(piece), ranks.get, heapq.heappop, heapq.heappush
    after, before = list(range(1, n + 1)), list(range(-1, n))  # of a place that was merged away, after is 0
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = pop(heap)
        middle = after[i]
        if not middle or middle >= n or after[middle] != end:
            continue
        after[middle], after[i], before[end] = 0, end, i
        if end < n and (rank := get(piece[i : after[end]])) is not None:
            push(heap, (rank, i, after[end]))
        a = before[i]
        if a >= 0 and (rank := get(piece[a:end])) is not None:
            push(heap, (rank, a, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return tuple(out)


class Encoder:
    """A worker's encoder."""

    def __init__(self, vocabulary: Vocabulary, window: int = WINDOW) -> None:
        self.vocabulary, self.window, self.ranks, self.known = vocabulary, window, vocabulary.merges(), {}

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where those of each begin, with the total as last."""
        raw, at = bytes_of(text)
        try:
            points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        except UnicodeDecodeError:
            data = raw.tobytes()
            return self.encode(pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)], pa.large_string()))
        wide = np.ones(len(points), np.int8)
        for least in (0x80, 0x800, 0x10000):
            wide += points >= least
        offset = np.concatenate([[0], np.cumsum(wide, dtype=np.int64)])
        first = np.searchsorted(offset, at)
        if len(points) <= self.window:
            return self.ids(raw, offset, pretokens(points, first, self.vocabulary.kinds), first)
        parts = [self.long(raw, offset[a : b + 1], points[a:b]) if b > a else np.zeros(0, np.uint32) for a, b in zip(first[:-1], first[1:], strict=True)]
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])

    def long(self, raw: np.ndarray, offset: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Ids of one text, by windows. What ends near a window's end may go on behind it and is left to the next."""
        out, at, size = [], 0, self.window
        while at < len(points):
            part = points[at : at + size]
            begins = pretokens(part, np.array([0, len(part)]), self.vocabulary.kinds)
            if at + size < len(points):
                if len(begins) < 5:
                    size *= 2
                    continue
                part, begins = part[: begins[-4]], begins[:-4]
            out.append(self.ids(raw, offset[at : at + len(part) + 1], begins, np.array([0, len(part)]))[0])
            at, size = at + len(part), self.window
        return np.concatenate(out)

    def ids(self, raw: np.ndarray, offset: np.ndarray, begins: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(begins):
            return np.zeros(0, np.uint32), np.zeros(len(first), np.int64)
        start, end = offset[begins], offset[np.append(begins[1:], first[-1])]
        _, one, which = np.unique(h := hashes(raw, start, end), return_index=True, return_inverse=True)
        start, end = start[one], end[one]
        rank = self.vocabulary.ranks_of(raw, start, end, h[one])
        size = np.ones(len(one), np.int64)
        missed = np.flatnonzero(rank < 0)
        found = [self.merge(raw[a:b].tobytes()) for a, b in zip(start[missed], end[missed], strict=True)]
        size[missed] = [len(x) for x in found]
        place = np.cumsum(size) - size
        flat = np.zeros(int(size.sum()), np.uint32)
        flat[place[rank >= 0]] = rank[rank >= 0]
        flat[np.repeat(place[missed], size[missed]) + within(size[missed])] = np.fromiter(chain.from_iterable(found), np.uint32, int(size[missed].sum()))
        each = size[which]
        total = np.concatenate([[0], np.cumsum(each)])
        return flat[np.repeat(place[which], each) + within(each)], total[np.searchsorted(begins, first)]

    def merge(self, piece: bytes) -> tuple[int, ...]:
        found = self.known.get(piece)
        if found is None:
            found = merged(piece, self.ranks)
            if len(piece) <= REMEMBERED_BYTES:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[piece] = found
        return found


def encoded(docs: DataFrame, path: str | None = None, column: str = "text", ids: str = "ids", window: int = WINDOW) -> DataFrame:
    """docs with ids (array<int>) and, packed as little-endian unsigned 32-bit integers, `ids`_packed (binary) in place of the text. path: a rank file."""
    path = path or default_ranks()
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    own = docs.select(F.col(f"`{column}`").alias("_text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in (column, ids, f"{ids}_packed")), F.lit(0).alias("_end")).alias("_own"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = worker_state(f"bpe_encoder_{path}_{window}", lambda: Encoder(sent.value, window))
        values, first = encoder.encode(batch.column(0))
        values = np.ascontiguousarray(values, "<u4")
        at = first.astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(at), pa.array(values.view(np.int32)))
        packed = pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((4 * at).astype(np.int32)), pa.py_buffer(values)])
        return pa.RecordBatch.from_arrays([batch.column(1), lists, packed], ["_own", ids, f"{ids}_packed"])

    out = arrow_map(own, run, own.select("_own", F.array(F.lit(0)).alias(ids), F.lit(b"").alias(f"{ids}_packed")).schema, "_text")
    return out.select(*(F.col("_own").getField(c).alias(c) for c in own.schema["_own"].dataType.names if c != "_end"), ids, f"{ids}_packed")


def decoded(rows: DataFrame, path: str | None = None, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """rows with the bytes (binary) of their ids in place of these. Null ids give null; an id outside the vocabulary is an error."""
    sent = rows.sparkSession.sparkContext.broadcast(vocabulary(path or default_ranks()))
    own = rows.select(F.col(f"`{ids}`").cast("array<int>").alias("_ids"), F.struct(*(F.col(f"`{c}`") for c in rows.columns if c not in (ids, column)), F.lit(0).alias("_end")).alias("_own"))

    def run(batches):
        raw, starts = sent.value.raw, sent.value.at
        for batch in batches:
            lists = batch.column(0)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(values) and (values.min() < 0 or values.max() >= len(starts) - 1):
                raise ValueError("an id outside the vocabulary")
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            size = starts[values + 1] - starts[values]
            data = raw[np.repeat(starts[values], size) + within(size)]
            at = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
            found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
            if lists.null_count:
                found = pc.if_else(lists.is_null(), pa.scalar(None, pa.binary()), found)
            yield pa.RecordBatch.from_arrays([batch.column(1), found], ["_own", column])

    out = own.mapInArrow(run, StructType([own.schema["_own"], StructField(column, BinaryType())]))
    return out.select(*(F.col("_own").getField(c).alias(c) for c in own.schema["_own"].dataType.names if c != "_end"), column)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encoded(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    told = rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("ids_packed", 256).alias("ids_sha256"), "ids")
    return decoded(told).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
