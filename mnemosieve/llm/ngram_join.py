"""Jaccard join of documents on word shingles in their metric space, and the components of its links.

1. A document's set of shingles becomes sorted 64-bit hashes; equal sets share a node, so copies are joined once.
   A set of n shingles of which more than n - ceil(t n) occur in no other document has nobody within the link distance. Fingerprints of a fixed
   share of all shingles, packed by hash range, show which do: a clash of fingerprints, or a shingle outside the share, only keeps a set in.
2. Two of the other sets that link share one of their first n - ceil(t n) + 1 shingles in any common order. Ours puts the frequent ones last, so common
   passages bring nobody together. For each shingle that several nodes put first, the smallest of them is the pivot, and the pivot's region is
   all who share such a shingle with it: linked sets meet in a region.
3. A region joins exactly, by Voronoi cells of pivots among its sets (r: the link distance). A set within r of its nearest pivot belongs to that pivot's
   cell; all of a cell are linked to the pivot and so one component. By the triangle inequality, a set linked to one of the cell is at most 2 r from the
   pivot, and at most 2 r farther from it than from its own nearest one: such sets are the cell's window. Cell and window are joined, with distances to
   all pivots and rarest shingles pruning pairs, and pairs already connected left out. Sets in no cell join recursively, with pivots among themselves;
   where pivots gather nobody any more, the rest is joined by its rarest shingles.
4. A region too large for a task does the same in tables: its sets are measured against several pivots, in pieces; each goes to the cell of its nearest
   pivot and, by the triangle inequality, to those at most 2 r farther. Cells are regions again, recursively. Where that would not save work, sets in
   reach of each other meet in pairs of bounded blocks.
5. Components: labels sink to the smallest node along links, with pointer jumping, in tables on the shared folder; labels of hot nodes and components are
   broadcast to their rows, so no task holds a whole component.

Hashing: two different words or shingles agree with a chance of about 2**-64 a pair, as do two different sets; otherwise the join is exact.

Defined results: null counts as empty; a text without words has n_shingles 0 and is its own component; a text of fewer words than a shingle has
one, its whole sequence; repeated rows and equal sets share a component; a row with a null doc_id lends no id to a component; texts are read
whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemosieve.llm.common import arrow_map, attach_groups, BATCH_ROWS, carried, mix64, read_table, released, restored, slices, WordHasher, worker_state, written

WORDS, PERCENT = 4, 85
#: Shingles known to be frequent at most (they only order the others, whatever is left out); documents of a slice that make one a candidate.
FREQUENT, OFTEN = 50_000, 3
#: Bytes of text whose fingerprints travel together.
SLICE = 4 << 20
#: Share of the hash range whose shingles are looked up over all documents; fingerprints one task compares; bits beyond the count's own.
LOOKED_UP, RANGE, SPARE_BITS = 0.4, 2_000_000, 4
#: Shingles of a region, or of two blocks of a ring, that one task joins.
REGION = 2_000_000
#: Sets that are compared with each other directly; pivots of a region and of one too large for a task; pivots in a row that gather nobody.
FEW, PIVOTS, LARGE_PIVOTS, IDLE = 16, 12, 8, 3
#: Share of a region's work (pairs) that its cells may have for a split to count; levels of splits at most.
SAVES, LEVELS = 0.5, 6
#: Bytes of the filter that tells which rows' texts are moved, at most; beyond, more rows are moved in vain, and none is lost.
FILTER_BYTES, FILTER_PARTS, FILTER_BITS = 32 << 20, 64, 12
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


class Shingler:
    """Sorted distinct shingle hashes of each text."""

    def __init__(self) -> None:
        self.hasher = WordHasher()

    def sets(self, text: pa.Array, n: int) -> list[np.ndarray]:
        word, _, _, first, _ = self.hasher.words(text)
        k = max(0, len(word) - n + 1)
        total = np.zeros(k, np.uint64)
        for i in range(n):
            total += word[i : i + k] * np.uint64(MULTIPLIERS[i % len(MULTIPLIERS)] + 2 * (i // len(MULTIPLIERS)))
        hashes = mix64(total)
        out = []
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= n:
                found = np.sort(hashes[a : b - n + 1])
                out.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
            elif b > a:
                h = np.full(1, b - a, np.uint64)
                for i in range(a, b):
                    h = mix64(h * np.uint64(MULTIPLIERS[0]) + word[i : i + 1])
                out.append(h)
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def nodes_of(sets: list[np.ndarray]) -> np.ndarray:
    """The node of each set, a signed 64-bit number; 0 for an empty one."""
    size = np.array([len(x) for x in sets], np.int64)
    out = np.zeros(len(sets), np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        flat = mix64(np.concatenate([sets[i] for i in some]) ^ np.uint64(MULTIPLIERS[1]))
        total = np.add.reduceat(flat, np.cumsum(size[some]) - size[some])
        out[some] = mix64(total + size[some].astype(np.uint64) * np.uint64(MULTIPLIERS[2]))
    return out.view(np.int64)


def first_shingles(found: np.ndarray, frequent: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """The set's first n - ceil(t n) + 1 shingles: rare ones by hash, then frequent ones by frequency. frequent: sorted; rank: its order."""
    n = len(found)
    need = n - (percent * n + 99) // 100 + 1
    if not len(frequent):
        return found[:need]
    at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
    often = frequent[at] == found
    rare = found[~often]
    if len(rare) >= need:
        return rare[:need]
    rest = found[often]
    return np.concatenate([rare, rest[np.argsort(rank[at[often]], kind="stable")][: need - len(rare)]])


class Region:
    """Sets to be joined exactly; label: each set's component so far."""

    def __init__(self, sets: list[np.ndarray], percent: int, together: np.ndarray | None = None) -> None:
        self.sets, self.percent = sets, percent
        self.size = np.array([len(x) for x in sets], np.int64)
        self.label = np.arange(len(sets))
        self.cells = 0  # Voronoi cells of more than their pivot
        if together is not None and together.any():
            self.label[together] = np.flatnonzero(together)[0]

    def linked(self, both: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray | bool:
        return 100 * both >= self.percent * (a + b - both)

    def join(self, a: int, b: int) -> None:
        if self.label[a] != self.label[b]:
            self.label[self.label == self.label[b]] = self.label[a]

    def compare(self, a: int, b: int) -> bool:
        x, y = self.sets[a], self.sets[b]
        if len(x) > len(y):
            x, y = y, x
        if 100 * len(x) < self.percent * len(y):
            return False
        at = np.searchsorted(y, x)
        at[at == len(y)] = len(y) - 1
        return bool(self.linked(int((y[at] == x).sum()), len(x), len(y)))

    def distances(self, members: np.ndarray, flat: np.ndarray, pivot: int) -> tuple[np.ndarray, np.ndarray]:
        """Jaccard distance of each member to the pivot, and whether they are linked. flat: the members' shingles."""
        p = self.sets[pivot]
        at = np.minimum(np.searchsorted(p, flat), len(p) - 1)
        size = self.size[members]
        both = np.add.reduceat((p[at] == flat).astype(np.int64), np.cumsum(size) - size)
        linked = self.linked(both, size, len(p))
        for i in members[linked]:
            self.join(pivot, i)
        return 1 - both / (size + len(p) - both), linked

    def solve(self, members: np.ndarray) -> None:
        """Joins the members by Voronoi cells, recursively."""
        while len(members) > FEW and (self.label[members] != self.label[members[0]]).any():
            r, flat = 1 - self.percent / 100 + 1e-9, np.concatenate([self.sets[i] for i in members])
            covered, columns, pivots, idle = np.zeros(len(members), bool), [], [], 0
            while len(pivots) < PIVOTS and idle < IDLE and not covered.all():
                at = int(np.argmin(covered))  # members are in no order of content, so dense parts get pivots first
                d, linked = self.distances(members, flat, members[at])
                before = int(covered.sum())
                covered |= linked
                idle = idle + 1 if covered.sum() == before + 1 else 0
                columns.append(d)
                pivots.append(at)
            d = np.stack(columns, 1)
            home, least = d.argmin(1), d.min(1)
            for k in range(len(pivots)):
                cell = np.flatnonzero(covered & (home == k))
                if len(cell) < 2:  # a pivot alone: those linked to it have been joined
                    continue
                self.cells += 1
                window = np.flatnonzero((home != k) | ~covered)
                window = window[(d[window, k] <= least[window] + 2 * r) & (d[window, k] <= 2 * r)]
                if len(window):
                    self.by_rarest(members[cell], members[window], d[cell], d[window])
            rest = np.flatnonzero(~covered)
            if idle >= IDLE and len(rest):
                self.by_rarest(members[rest], None, d[rest], None)
                return
            members = members[rest]
        for i, a in enumerate(members[:FEW] if len(members) <= FEW else []):
            for b in members[i + 1 :]:
                if self.label[a] != self.label[b] and self.compare(a, b):
                    self.join(a, b)

    def by_rarest(self, some: np.ndarray, others: np.ndarray | None, d: np.ndarray, d_others: np.ndarray | None) -> None:
        """Exact join of some sets with others, or among themselves, by their rarest shingles; d: distances to common pivots."""
        members = some if others is None else np.concatenate([some, others])
        away = d if others is None else np.concatenate([d, d_others])
        flat = np.concatenate([self.sets[i] for i in members])
        values, place, count = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(values), np.int64)
        rank[np.argsort(count, kind="stable")] = np.arange(len(values))
        ordered, ends = rank[place], np.cumsum(self.size[members])
        lists: dict[int, list[int]] = {}
        r = 1 - self.percent / 100 + 1e-9
        for i, (member, end) in enumerate(zip(members, ends, strict=True)):
            mine = ordered[end - self.size[member] : end]
            n = len(mine)
            need = n - (self.percent * n + 99) // 100 + 1
            listed = others is None or i < len(some)
            found: list[int] = []
            for token in (np.partition(mine, need - 1)[:need] if need < n else mine).tolist():
                if others is None or not listed:
                    found += lists.get(token, ())
                if listed:
                    lists.setdefault(token, []).append(i)
            if not found:
                continue
            near = np.unique(np.array(found))
            near = near[self.label[members[near]] != self.label[member]]
            near = near[np.abs(away[near] - away[i]).max(1) <= r]
            near = near[np.argsort((away[near] + away[i]).min(1), kind="stable")]
            for other in members[near]:
                if self.label[other] != self.label[member] and self.compare(member, other):
                    self.join(member, other)


def join_sets(ids: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT, together: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (id, smallest id of its component) among some sets, none of them empty; together: sets known to be one component."""
    region = Region(sets, percent, together)
    region.solve(np.arange(len(sets)))
    smallest: dict[int, int] = {}
    for label, i in zip(region.label.tolist(), ids.tolist(), strict=True):
        smallest[label] = min(i, smallest.get(label, i))
    return [(i, smallest[label]) for label, i in zip(region.label.tolist(), ids.tolist(), strict=True) if smallest[label] != i]


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first columns, of sorted batches."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def _arrays(names: list[str], rows: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _joined(percent: int, keys: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows: keys, rep, together, shingles, sorted by the keys. Gives links."""
    out: list[tuple] = []
    for _, rows in _groups(batches, keys):
        seen = {rep: (together, found) for rep, together, found in rows}
        if len(seen) > 1:
            out += join_sets(np.array(list(seen)), [np.frombuffer(x, "<u8") for _, x in seen.values()], percent, np.array([t for t, _ in seen.values()], bool))
        if len(out) > 10_000:
            yield _arrays(["a", "b"], out, [pa.int64()] * 2)
            out = []
    if out:
        yield _arrays(["a", "b"], out, [pa.int64()] * 2)


def _by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys)


def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest id it reaches) of every id in links (a, b)."""
    both = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    degree = written(both.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.min("a").alias("m")), "degrees")  # both holds each link both ways
    labels = degree.select(F.col("b").alias("id"), F.least("b", "m").alias("component"))
    while True:
        told = degree.select("b", "n").join(labels.select(F.col("id").alias("b"), "component"), "b")
        lowest = attach_groups(both, written(told, "told"), ["b"], "n").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m"))
        sunk = written(labels.join(lowest, "id").select("id", F.least("component", "m").alias("c"), F.col("component").alias("old")), "labels")
        sizes = sunk.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
        parent = sunk.select(F.col("id").alias("c"), F.col("c").alias("up")).join(sizes, "c")
        jumped = written(attach_groups(sunk, written(parent, "parents"), ["c"], "n").select("id", F.least("c", "up").alias("component"), "old"), "labels")
        if jumped.where("component <> old").isEmpty():
            return jumped.select("id", "component")
        labels = jumped.select("id", "component")


def _measured(sets: DataFrame, percent: int, most: int, pivots: int = LARGE_PIVOTS) -> DataFrame:
    """region, rep, n, d (distance to each pivot), core (the pivots it is linked to, as reps) of sets (region, total, rep, n, shingles)."""
    pieces = F.ceil(F.col("total") * 2 / most).cast("int")
    chosen = sets.groupBy("region", F.pmod(F.xxhash64("rep"), F.lit(pivots)).alias("k")).agg(F.min("rep").alias("rep")).drop("k")
    center = sets.join(chosen, ["region", "rep"]).withColumns({"piece": F.explode(F.sequence(F.lit(0), pieces - 1)), "center": F.lit(True)})
    others = sets.withColumns({"piece": F.pmod(F.xxhash64("rep"), pieces).cast("int"), "center": F.lit(False)})
    columns = ["region", "piece", "center", "rep", "n", "shingles"]
    rows = center.select(*columns).unionByName(others.select(*columns))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, middle = None, []
        for batch in batches:
            out: list[tuple] = []
            for region, piece, is_center, rep, n, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = np.frombuffer(found, "<u8")
                if key != (region, piece):
                    key, middle = (region, piece), []
                if is_center:
                    middle.append((rep, found))
                    continue
                d, core = [], []
                for pivot, other in middle:
                    at = np.minimum(np.searchsorted(other, found), len(other) - 1)
                    both = int((other[at] == found).sum())
                    union = len(found) + len(other) - both
                    d.append(1 - both / union)
                    if 100 * both >= percent * union:
                        core.append(pivot)
                out.append((region, rep, n, d, core))
            yield _arrays(["region", "rep", "n", "d", "core"], out, [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64())])

    dealt = rows.repartition("region", "piece").sortWithinPartitions("region", "piece", F.desc("center"), "rep")
    return written(dealt.mapInArrow(released(measure), "region string, rep long, n long, d array<double>, core array<long>"), "measured")


def _large_regions(sets: DataFrame, percent: int, most: int) -> DataFrame:
    """Links of regions over `most` shingles. sets: region, total, rep, n, shingles."""
    reach, near = 2 * (1 - percent / 100) + 1e-6, 1 - percent / 100 + 1e-12
    links: list[DataFrame] = []
    for level in range(LEVELS):
        measured = _measured(sets, percent, most)
        links.append(measured.select(F.col("rep").alias("x"), F.explode("core").alias("y")).where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")))
        least = F.array_min("d")
        # a cell holds the sets whose nearest pivot is its own, and those that may be linked with them
        inside = measured.withColumns({"least": least, "home": F.array_position("d", least)}).select("region", "rep", "n", "least", "home", F.posexplode("d").alias("k", "x"))
        inside = inside.where(f"k + 1 = home or x <= least + {reach}").withColumns({"cell": F.concat_ws("/", "region", "k"), "together": F.col("x") <= near}).select("region", "cell", "rep", "n", "together")
        cells = inside.groupBy("region", "cell").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows"), F.max((~F.col("together")).cast("int")).alias("others"))
        cells = written(cells.where("others = 1").drop("others"), "cells")  # else the cell is one component
        work = cells.groupBy("region").agg(F.sum(F.col("total").cast("double") * F.col("total")).alias("work"))
        whole = measured.groupBy("region").agg(F.sum("n").cast("double").alias("whole"), F.count(F.lit(1)).alias("rows"))
        saves = F.lit(level + 1 < LEVELS) & (F.coalesce(F.col("work"), F.lit(0.0)) <= SAVES * F.col("whole") * F.col("whole"))
        told = written(whole.join(work, "region", "left").select("region", "rows", saves.alias("split")), "split")
        links.append(_blocks(sets, attach_groups(measured.select("region", "rep", "d"), told, ["region"], "rows").where("not split"), percent, most))
        cells = written(cells.join(told.where("split").select("region"), "region", "left_semi").drop("region"), "cells")
        if cells.isEmpty():
            break
        placed = attach_groups(inside.drop("n"), cells, ["cell"], "rows").drop("rows")
        placed = written(sets.drop("total").join(placed, ["region", "rep"]).drop("region").withColumnRenamed("cell", "region"), "cell-sets")
        small = _by_key(placed.where(F.col("total") <= most).select("region", "rep", "together", "shingles"), ["region"])
        links.append(small.mapInArrow(released(lambda it: _joined(percent, 1, it)), "a long, b long"))
        sets = placed.where(F.col("total") > most).select("region", "total", "rep", "n", "shingles")
        if sets.isEmpty():
            break
    return reduce(DataFrame.unionByName, [written(x, "region-links") for x in links])


def _blocks(sets: DataFrame, first: DataFrame, percent: int, most: int) -> DataFrame:
    """Links of regions that distances don't part, by pairs of bounded blocks; sets that are linked to the first pivot are known to be together."""
    first = first.select("region", "rep", (F.get("d", F.lit(0)) <= 1 - percent / 100 + 1e-12).alias("together"))
    blocks = F.ceil(F.col("total") * 2 / most).cast("int")
    placed = sets.join(first, ["region", "rep"]).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("region", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "together", "shingles")
    keys = ["region", "i", "j"]
    return _by_key(placed, keys).mapInArrow(released(lambda it: _joined(percent, 3, it)), "a long, b long")


class KeyFilter:
    """Bits that say which 64-bit keys may be among some; every key that is passes."""

    def __init__(self, keys: DataFrame, column: str, count: int) -> None:
        size = max(64, min(FILTER_BYTES, count * FILTER_BITS // 8) // FILTER_PARTS)
        parts = keys.select(F.col(column).alias("key")).repartition(FILTER_PARTS, F.pmod(F.col("key"), F.lit(FILTER_PARTS)))

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: dict[int, np.ndarray] = {}
            for batch in batches:
                key = batch.column(0).to_numpy()
                for part in np.unique(key % FILTER_PARTS):
                    flags = kept.setdefault(int(part), np.zeros(size * 8, bool))
                    for at in KeyFilter.places(key[key % FILTER_PARTS == part], size):
                        flags[at] = True
            yield _arrays(["part", "bits"], [(k, np.packbits(x).tobytes()) for k, x in kept.items()], [pa.int32(), pa.binary()])

        self.size, self.bits = size, np.zeros((FILTER_PARTS, size), np.uint8)
        for row in parts.mapInArrow(released(mark), "part int, bits binary").collect():  # FILTER_PARTS rows of `size` bytes
            self.bits[row["part"]] = np.frombuffer(row["bits"], np.uint8)

    @staticmethod
    def places(key: np.ndarray, size: int) -> list[np.ndarray]:
        h = mix64(key.astype(np.int64).view(np.uint64))
        return [((h >> np.uint64(20 * i)) % np.uint64(size * 8)).astype(np.int64) for i in range(3)]

    def may_hold(self, key: np.ndarray) -> np.ndarray:
        part, out = key % FILTER_PARTS, np.ones(len(key), bool)
        for at in self.places(key, self.size):
            out &= (self.bits[part, at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
        return out


def packed(values: np.ndarray, size: int) -> bytes:
    """Ascending numbers as differences of `size` bytes; the largest code advances without giving a number."""
    step = np.diff(values, prepend=np.uint64(0))
    marker = np.uint64((1 << 8 * size) - 1)
    over = (step // marker).astype(np.int64)
    out = np.full(int(over.sum()) + len(step), marker, "<u8")
    out[np.cumsum(over + 1) - 1] = step % marker
    return out.view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def unpacked(data: bytes, size: int) -> np.ndarray:
    wide = np.zeros((len(data) // size, 8), np.uint8)
    wide[:, :size] = np.frombuffer(data, np.uint8).reshape(-1, size)
    step = wide.reshape(-1).view("<u8").astype(np.uint64)
    return np.cumsum(step)[step != np.uint64((1 << 8 * size) - 1)]


SEVERAL = 65_535  # stands for the documents of a slice that share a shingle


def unshared_shingles(docs: DataFrame, words: int, total: int) -> DataFrame:
    """node, n, unshared: how many of its looked-up shingles occur in no other document, for each node of each slice of documents. total: shingles."""
    bits = min(60, max(16, total.bit_length() + SPARE_BITS))
    ranges = max(1, int(total * LOOKED_UP) // RANGE)
    width = -(-int(LOOKED_UP * (1 << bits)) // ranges)
    schema = "slice long, range int, a binary, b binary"
    names, kinds = ["slice", "range", "a", "b"], [pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def code_size(entries: int) -> int:
        return next(k for k in range(1, 8) if 1 << 8 * k > 6 * width // entries)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for part in (x for batch in batches for x in slices(batch, "text", SLICE)):
            sets = [x for some in slices(part, "text") for x in worker_state("shingler", Shingler).sets(some.column(0), words)]
            nodes, first = np.unique(nodes_of(sets), return_index=True)
            size = np.array([len(sets[i]) for i in first], np.int64)
            flat, owner = np.concatenate([sets[i] for i in first]), np.repeat(np.arange(len(first)), size)
            keep = flat < np.uint64(int(LOOKED_UP * 2**64))
            flat, owner = flat[keep] >> np.uint64(64 - bits), owner[keep].astype(np.uint16)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            new = np.ones(len(flat), bool)
            new[1:] = flat[1:] != flat[:-1]
            again = np.zeros(len(flat), bool)
            again[:-1] = ~new[1:]
            owner[new & again] = SEVERAL
            flat, owner = flat[new], owner[new]
            rows = [(number, -1, nodes.astype("<i8").tobytes(), size.astype("<i8").tobytes())]
            cuts = np.searchsorted(flat, np.arange(ranges + 1, dtype=np.uint64) * np.uint64(width))
            for k in range(ranges):
                lo, hi = cuts[k], cuts[k + 1]
                if hi > lo:
                    code = code_size(int(hi - lo))
                    rows.append((number, k, bytes([code]) + packed(flat[lo:hi] - np.uint64(k * width), code), owner[lo:hi].astype("<u2").tobytes()))
            yield _arrays(names, rows, kinds)
            number += 1

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (which,), rows in _groups((b.select(["range", "slice", "a", "b"]) for b in batches), 1):
            if which < 0:
                yield _arrays(names, [(s, -1, a, b) for s, a, b in rows], kinds)
                continue
            values = [unpacked(a[1:], a[0]) for _, a, _ in rows]
            flat, owner = np.concatenate(values), np.frombuffer(b"".join(b for *_, b in rows), "<u2")
            order = np.argsort(flat, kind="stable")
            same = flat[order][1:] == flat[order][:-1]
            shared = np.zeros(len(flat), bool)
            shared[order[1:][same]] = True
            shared[order[:-1][same]] = True
            alone = ~shared & (owner != SEVERAL)
            ends = np.cumsum([len(x) for x in values])
            out = [(s, which, np.bincount(owner[e - len(x) : e][alone[e - len(x) : e]]).astype("<u2").tobytes(), b"") for (s, _, _), x, e in zip(rows, values, ends, strict=True)]
            yield _arrays(names, out, kinds)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, 1):
            _, nodes, size = next(x for x in rows if x[0] < 0)
            nodes, size = np.frombuffer(nodes, "<i8"), np.frombuffer(size, "<i8")
            count = np.zeros(len(nodes), np.int64)
            for which, a, _ in rows:
                if which >= 0:
                    part = np.frombuffer(a, "<u2")
                    count[: len(part)] += part
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(size), pa.array(count)], ["node", "n", "unshared"])

    told = docs.select("text").mapInArrow(released(look_up), schema).withColumn("_to", F.when(F.col("range") < 0, F.xxhash64("slice")).otherwise(F.col("range").cast("long")))
    compared = told.repartition("_to").sortWithinPartitions("range", "slice").drop("_to").mapInArrow(released(compare), schema)
    return compared.repartition("slice").sortWithinPartitions("slice", "range").mapInArrow(released(add_up), "node long, n long, unshared long")


def _row_key():
    """Of a row with doc_id and text: two rows that differ in either share it with a chance of about 2**-64."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def linked(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, region: int = REGION) -> DataFrame:
    """doc_id, n_shingles, component_id for each row."""
    return _placed(docs, words, percent, region).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _placed(docs: DataFrame, words: int, percent: int, region: int = REGION) -> DataFrame:
    """doc_id, row_key, n, component (a node; null without shingles), component_id for each row. Sets are known by their nodes, never by a doc_id."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("row_key", _row_key())

    def describe(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = worker_state("shingler", Shingler).sets(batch.column(1), words)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(nodes_of(sets)), pa.array([len(x) for x in sets], pa.int64())], ["doc_id", "row_key", "node", "n"])

    slim = written(arrow_map(docs, describe, "doc_id long, row_key long, node long, n long"), "nodes-of-rows")
    nodes = written(slim.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.min("row_key").alias("row_key"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")), "nodes")
    total = slim.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    near = unshared_shingles(docs, words, total).where(f"n > 0 and unshared <= n - floor(({percent} * n + 99) / 100)").select("node").distinct()
    wanted = written(nodes.join(near, "node").select("row_key", "node"), "wanted")

    moved = spark.sparkContext.broadcast(KeyFilter(wanted, "row_key", wanted.count()))

    def describe_wanted(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        some = batch.filter(pa.array(moved.value.may_hold(batch.column(0).to_numpy())))
        if not some.num_rows:
            return None
        sets = worker_state("shingler", Shingler).sets(some.column(1), words)
        shingles = pa.array([x.astype("<u8").tobytes() for x in sets], pa.binary())
        return pa.RecordBatch.from_arrays([some.column(0), pa.array(nodes_of(sets)), pa.array([len(x) for x in sets], pa.int64()), shingles], ["row_key", "node", "n", "shingles"])

    sets = arrow_map(docs.select("row_key", "text"), describe_wanted, "row_key long, node long, n long, shingles binary")  # texts stay where they are
    sets = sets.join(wanted.withColumnRenamed("row_key", "own").hint("merge"), "node").where("row_key = own").dropDuplicates(["node"])
    sets = written(sets.select(F.col("node").alias("rep"), "node", "n", "shingles"), "sets")

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, count = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u8"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values[count >= OFTEN].view(np.int64)), pa.array(count[count >= OFTEN].astype(np.int64))], ["shingle", "n"])

    common = written(sets.select("shingles").mapInArrow(released(frequent), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")), "frequent")
    cut, seen = 1 << 62, 0  # the frequent: as many classes of frequencies, a class for each doubling, as FREQUENT holds
    for r in common.groupBy(F.floor(F.log2("n")).alias("class")).count().orderBy(F.desc("class")).collect():
        seen += r["count"]
        if seen > FREQUENT:
            break
        cut = 1 << r["class"]
    common = sorted(common.where(F.col("n") >= cut).collect(), key=lambda r: (-r["n"], r["shingle"]))  # FREQUENT rows at most
    hashes = np.array([r["shingle"] for r in common], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    often = spark.sparkContext.broadcast((hashes[order], (len(hashes) - np.arange(len(hashes)))[order]))  # FREQUENT numbers at most

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [first_shingles(np.frombuffer(x, "<u8"), *often.value, percent) for x in batch.column(1).to_pylist()]
            if heads:
                node = np.repeat(batch.column(0).to_numpy(), [len(x) for x in heads])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(heads).astype(np.uint64).view(np.int64)), pa.array(node)], ["shingle", "node"])

    posted = written(sets.select("node", "shingles").mapInArrow(released(postings), "shingle long, node long"), "posted")
    shared = written(posted.groupBy("shingle").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("k")).where("k > 1"), "shared")
    members = written(attach_groups(posted, shared, ["shingle"], "k").where("node <> pivot").select("pivot", "node").distinct(), "members")
    inside = members.unionByName(members.select("pivot", F.col("pivot").alias("node")).distinct())
    regions = written(inside.join(sets.select("node", "n"), "node").groupBy("pivot").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows")), "regions")
    pivots = attach_groups(inside, regions, ["pivot"], "rows").groupBy("node").agg(F.collect_list(F.struct("pivot", "total")).alias("pivots"))  # fewer than a set's first shingles
    placed = sets.join(pivots.hint("merge"), "node").withColumn("p", F.explode("pivots")).select("p.total", "p.pivot", "rep", "n", "shingles")
    some_large = not regions.where(F.col("total") > region).isEmpty()
    if some_large:
        placed = written(placed, "region-sets")
    small = _by_key(placed.where(F.col("total") <= region).select("pivot", "rep", F.lit(False).alias("together"), "shingles"), ["pivot"])
    links = small.mapInArrow(released(lambda it: _joined(percent, 1, it)), "a long, b long")
    if some_large:
        large = placed.where(F.col("total") > region).select(F.col("pivot").cast("string").alias("region"), "total", "rep", "n", "shingles")
        links = links.unionByName(_large_regions(large, percent, region))
    found = components(written(links, "links"))
    joined = written(nodes.join(found.withColumnRenamed("id", "node"), "node", "left").select("node", "copies", "least", F.coalesce("component", "node").alias("component")), "joined")
    several = joined.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members"))
    groups = attach_groups(joined.drop("least"), written(several, "components"), ["component"], "members").select("node", "copies", "component", "component_id")
    full = attach_groups(slim.where("n > 0"), written(groups, "groups"), ["node"], "copies")
    columns = ["doc_id", "row_key", "n", "component", "component_id"]
    empty = slim.where("n = 0").withColumns({"component": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    return full.select(*columns).unionByName(empty.select(*columns))


def representatives(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of docs of which one stays for each component: the one whose doc_id names it; one with a null doc_id where the component has no other.
    A text without shingles is no near copy of another. Rows that repeat both doc_id and text leave one; those that share a doc_id only are kept apart."""
    placed = written(_placed(docs, words, percent), "placed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("r")
    keep = placed.where("n > 0").groupBy("component").agg(first).select("r.row_key").unionByName(placed.where("n = 0").select("row_key"))
    keep = written(keep.select(F.col("row_key").alias("_row_key")).distinct(), "kept")
    out = carried(docs, _row_key().alias("_row_key")).join(keep, "_row_key", "left_semi")
    if not docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        out = out.dropDuplicates(["_row_key"])
    return restored(out, docs)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(read_table(spark, sf_dir, "documents"))
