"""Best-fit packing of documents into sequences of bounded length (bin completion over a histogram of lengths).

Whatever the number of documents, at most `capacity` different lengths occur. So the search runs on the histogram: a *pattern* (a
filling of one sequence) is applied as many times as its lengths last. The driver holds the histogram and the patterns, both bounded by
the capacity; rows are only ranked within their length, and a rank decides the sequence and the offset.

Defined results: null and empty texts have no ids of their own and pack as the one end id; a repeated row is packed once for each
time it occurs; equal lengths are interchangeable, ties go by doc_id; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mnemosieve.llm.common import arrow_map, released, worker_state, written

CAPACITY, END_ID = 4096, 1
#: Nodes the search may visit after the best-fit start, however many lengths there are; fillings of one sequence it compares; rows ranked by one task.
NODES, FILLINGS, RANK_ROWS = 2000, 48, 100_000
#: At most FEW pieces are searched one by one; at most SMALL with all their fillings and as many nodes as it takes, remembering what was left before.
FEW, ALL_FILLINGS, SMALL, ALL_NODES = 64, 1000, 20, 200_000
#: Chunks a worker remembers the ids of in each of two generations, some 200 bytes each.
REMEMBERED = 300_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

Pattern = tuple[tuple[int, int], ...]  # (length, how often), longest first
Plan = list[tuple[Pattern, int]]  # a pattern and the number of sequences filled by it


def bins(plan: Plan) -> int:
    return sum(n for _, n in plan)


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing, all items of a length and all sequences of a residue at a time."""
    rooms: dict[int, list[list]] = {}
    free: list[int] = []  # residues that occur, ascending

    def put(residue: int, pattern: Pattern, n: int) -> None:
        if residue not in rooms:
            rooms[residue] = []
            insort(free, residue)
        rooms[residue].append([pattern, n])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(free, length)
            if at == len(free):
                each = capacity // length
                for k, n in ((each, left // each), (left % each, 1)):
                    if k and n:
                        put(capacity - k * length, ((length, k),), n)
                break
            residue = free[at]
            pattern, n = rooms[residue].pop()
            if not rooms[residue]:
                del rooms[residue], free[at]
            each = residue // length
            whole = min(n, left // each)
            left -= whole * each
            if whole:
                put(residue - each * length, (*pattern, (length, each)), whole)
            n -= whole
            if n and left:  # fewer than `each` are left
                put(residue - left * length, (*pattern, (length, left)), 1)
                n, left = n - 1, 0
            if n:
                put(residue, pattern, n)
    return [(p, n) for r in free for p, n in rooms[r]]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The larger of the volume bound and, over every limit k, the bound that items over capacity - k stand alone and those over half don't pair."""
    n = np.zeros(capacity + 1, np.int64)
    for length, c in counts.items():
        n[length] = c
    return _bound(n, capacity)


def _bound(n: np.ndarray, capacity: int) -> int:
    if not n.any():
        return 0
    many, volume = np.cumsum(n), np.cumsum(n * np.arange(capacity + 1))
    k = np.arange(capacity // 2 + 1)
    half = capacity // 2
    alone = many[-1] - many[capacity - k]
    big = many[capacity - k] - many[half]
    room = big * capacity - (volume[capacity - k] - volume[half])
    small = volume[half] - np.where(k > 0, volume[np.maximum(k - 1, 0)], 0)
    return int(max((volume[-1] + capacity - 1) // capacity, np.max(alone + big + np.maximum(0, -((room - small) // capacity)))))


def dominates(a: Pattern, b: Pattern) -> bool:
    """Whether the items of b fit into the items of a: whatever is packed with b packs with a as well."""
    rooms = sorted(x for x, k in a for _ in range(k))
    for item in (x for x, k in b for _ in range(k)):
        at = bisect_left(rooms, item)
        if at == len(rooms):
            return False
        insort(rooms, rooms.pop(at) - item)
    return True


def fillings(counts: dict[int, int], lengths: list[int], residue: int, most: int | None) -> list[Pattern]:
    """Undominated among at most `most` fillings of the residue (all, if None), least waste first. lengths: ascending, those that remain. Every length and
    every multiplicity is a branch; with a limit, the first branch may take half of what is left to find, so fillings differ from their longest item on."""
    found: list[tuple[int, Pattern]] = []

    def walk(below: int, residue: int, pattern: Pattern, most: int | None) -> int:
        at = min(bisect_left(lengths, residue + 1), below)
        if not at:
            found.append((residue, pattern))
            return 1
        done = 0
        for i in range(at - 1, -1, -1):
            length = lengths[i]
            for k in range(min(counts[length], residue // length), 0, -1):
                if most is not None and done >= most:
                    return done
                done += walk(i, residue - k * length, (*pattern, (length, k)), None if most is None else (most - done + 1) // 2)
        return done

    walk(len(lengths), residue, (), most)
    kept: list[tuple[int, Pattern]] = []
    for waste, pattern in sorted(set(found), key=lambda x: (x[0], sum(k for _, k in x[1]))):
        if not any(p == pattern or dominates(p, pattern) for _, p in kept):
            kept.append((waste, pattern))
    return [p for _, p in kept]


class Remaining:
    """Items that aren't packed yet: one histogram, changed and changed back along the search."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity, self.counts, self.lengths = capacity, dict(counts), sorted(counts)
        self.array = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.array[length] = n

    def add(self, pattern: Pattern, times: int) -> None:
        """times < 0 takes the pattern's items away."""
        for length, k in pattern:
            before = self.counts.get(length, 0)
            after = before + k * times
            self.array[length] = after
            if after:
                self.counts[length] = after
                if not before:
                    insort(self.lengths, length)
            else:
                del self.counts[length], self.lengths[bisect_left(self.lengths, length)]

    def moves(self, one_by_one: bool, small: bool = False) -> list[tuple[Pattern, int]]:
        """Sequences of the largest item with a filling, and how often each may be filled: as often as it lasts first, then once."""
        largest = self.lengths[-1]
        self.add(((largest, 1),), -1)
        found = fillings(self.counts, self.lengths, self.capacity - largest, None if small else ALL_FILLINGS if one_by_one else FILLINGS)
        self.add(((largest, 1),), 1)
        patterns = [((largest, 1 + filling[0][1]), *filling[1:]) if filling and filling[0][0] == largest else ((largest, 1), *filling) for filling in found]
        often = [min(self.counts[x] // k for x, k in p) for p in patterns]
        return [(p, 1 if one_by_one else n) for p, n in zip(patterns, often, strict=True)] + [(p, 1) for p, n in zip(patterns, often, strict=True) if n > 1 and not one_by_one]


def complete(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> Plan:
    """Bin completion: fill the sequence of the largest item, branch over its undominated fillings, prune by waste and bound, finish by best fit."""
    counts = {x: n for x, n in counts.items() if n}
    best, least = best_fit(counts, capacity), lower_bound(counts, capacity)
    fewest = bins(best)
    if fewest <= least:
        return best
    volume = sum(x * n for x, n in counts.items())
    one_by_one, small = sum(counts.values()) <= FEW, sum(counts.values()) <= SMALL
    nodes = max(nodes, ALL_NODES) if small else nodes
    left, plan, used, waste = Remaining(counts, capacity), [], 0, 0
    before: dict[tuple, int] = {}  # the fewest sequences with which the same items were left
    stack = [iter(left.moves(one_by_one, small))]
    while stack and nodes > 0 and fewest > least:
        move = next(stack[-1], None)
        if move is None:
            stack.pop()
        else:
            nodes -= 1
            pattern, times = move
            left.add(pattern, -times)
            plan.append(move)
            used += times
            waste += times * (capacity - sum(x * k for x, k in pattern))
            if waste <= (fewest - 1) * capacity - volume and used + _bound(left.array, capacity) < fewest:
                end = best_fit(left.counts, capacity)
                if used + bins(end) < fewest:
                    best, fewest = [*plan, *end], used + bins(end)
                key = tuple(sorted(left.counts.items())) if small else None
                if left.counts and (not small or before.get(key, fewest) > used):
                    before[key] = used
                    stack.append(iter(left.moves(one_by_one, small)))
                    continue
        if plan:
            pattern, times = plan.pop()
            left.add(pattern, times)
            used -= times
            waste -= times * (capacity - sum(x * k for x, k in pattern))
    return best


def slots(plan: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: the ranks at which its ranges begin, and each range's first sequence, number of sequences and offset."""
    out: dict[int, list[list[int]]] = {}
    next_rank: Counter[int] = Counter()
    sequence = 0
    for pattern, n in plan:
        offset = 0
        for length, k in pattern:
            out.setdefault(length, []).append([next_rank[length], sequence, n, offset])
            next_rank[length] += n * k
            offset += length * k
        sequence += n
    return {length: tuple(np.array(x, np.int64).T) for length, x in out.items()}


def pack(rows: DataFrame, order: list[str], capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """rows (a written table or another cheap, stable input) with sequence_id and offset. length: 1 to capacity; order: columns that break ties."""
    spark = rows.sparkSession
    counts = {int(r[0]): int(r[1]) for r in rows.groupBy(length).count().collect()}  # at most `capacity` rows
    schema = rows.schema.simpleString()[7:-1]
    if not counts:
        return rows.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    table = spark.sparkContext.broadcast(slots(complete(counts, capacity)))
    salts = spark.createDataFrame([(x, -(-n // RANK_ROWS)) for x, n in counts.items()], f"{length} long, _salts long")
    salted = rows.join(F.broadcast(salts), length).withColumn("_salt", F.pmod(F.xxhash64(*order), F.col("_salts")))
    before = (
        salted.groupBy(length, "_salt").count()
        .withColumn("_before", F.sum("count").over(Window.partitionBy(length).orderBy("_salt")) - F.col("count"))
        .select(length, "_salt", "_before")
    )
    ranked = (
        salted.withColumn("_rank", F.row_number().over(Window.partitionBy(length, "_salt").orderBy(*order)) - 1)
        .join(before, [length, "_salt"]).withColumn("_rank", (F.col("_rank") + F.col("_before")).cast("long"))
        .select(*rows.columns, "_rank")
    )

    names = [*rows.columns, "sequence_id", "offset"]

    def place(batches):
        ranges = table.value
        for batch in batches:
            size = batch.column(batch.schema.get_field_index(length)).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            for x in np.unique(size):
                at = np.flatnonzero(size == x)
                lo, first, n, begins = ranges[int(x)]
                k = np.searchsorted(lo, rank[at], "right") - 1
                j = rank[at] - lo[k]
                sequence[at] = first[k] + j % n[k]
                offset[at] = begins[k] + j // n[k] * x
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names)

    return ranked.mapInArrow(released(place), f"{schema}, sequence_id long, offset long")


class Chunks(dict):
    """Ids of texts as little-endian bytes, by their chunks between spaces where that gives the ids of the whole text.

    For a tokenizer that lower-cases and always parts tokens at white space, a text's ids are those of its chunks. Two things make chunks recur more often
    without changing ids: A-Z is lower-cased, and a run of ASCII symbols (but apostrophes) between a letter and white space, always tokens of its own,
    becomes a chunk. Whether the tokenizer is of that kind is read off its own steps and tried on PROBES; any other gets its texts whole.
    """

    PROBES = (
        "Ab cD  e\tF\nG. x", " A", "a b ", "Don't (x) [y]! we'll", "ÀÉ ß x Ñ", "中文 字 a中", "1,234.5% $x", "a--b ##c _d", "🙂 é e\u0301", "\u00a0x\u2003y", "<s> [CLS] </s>", "İ ſ ﬁ", "tok en izer", "x\u200by \u00ad", "",
    )

    SYMBOL = r"[!-&(-/:-@\[-`{-~]"
    MARK = re.compile(rf"({SYMBOL})(?<=[a-zß-öø-ÿ]{SYMBOL})({SYMBOL}*)(?=[ \n]|$)")
    LETTERS = re.compile(r"[a-zß-öø-ÿ]+")
    LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.older = tokenizer, {}
        ids = tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(ids.values()) + 1, bool)  # ids that end a word
        self.last[[i for token, i in ids.items() if token.endswith("</w>")]] = True
        self.special = [x.content for x in tokenizer.get_added_tokens_decoder().values()]  # a text that holds one is left as it is
        steps = json.loads(tokenizer.to_str())
        normalizer = steps.get("normalizer") or {}
        lowers = any(x.get("type") == "Lowercase" or x.get("type") == "BertNormalizer" and x.get("lowercase") for x in [normalizer, *normalizer.get("normalizers", [])])
        self.whole = not lowers or steps.get("truncation") is not None or steps.get("padding") is not None
        self.whole = self.whole or self.by_chunks(list(self.PROBES)) != self.directly(list(self.PROBES))
        self.clear()

    def learn(self, chunks: set[str]) -> None:
        words, rest = [], []
        for x in chunks:
            if x in self.older:
                self[x] = self.older[x]
            elif self.LETTERS.fullmatch(x):
                words.append(x)
            else:
                rest.append(x)
        for at in range(0, len(words), 1000):  # words of letters alone are told apart in one text by the ids that end words
            some = words[at : at + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(self.last[np.minimum(ids, len(self.last) - 1)]) + 1) * 4
            if len(ends) != len(some):  # another kind of tokenizer
                rest += some
                continue
            data, ends = ids.tobytes(), ends.tolist()
            self.update(zip(some, map(data.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
        for chunk, coded in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self[chunk] = np.array(coded.ids, "<u4").tobytes()

    def plain(self, text: str) -> str:
        lower = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").translate(self.LOWER).decode("utf-8", "surrogatepass")
        return text if any(x in lower for x in self.special) else self.MARK.sub(r" \1\2", lower)

    def directly(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, texts: list[str]) -> list[bytes]:
        return self.directly(texts) if self.whole else self.by_chunks(texts)

    def by_chunks(self, texts: list[str]) -> list[bytes]:
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()
        parts = [self.plain(x).replace("\n", " ").replace("\t", " ").split(" ") for x in texts]
        found = [list(map(self.get, x)) for x in parts]
        gaps = [[i for i, v in enumerate(x) if v is None] if None in x else () for x in found]
        self.learn({x[i] for x, at in zip(parts, gaps, strict=True) for i in at})
        for x, values, at in zip(parts, found, gaps, strict=True):
            for i in at:
                values[i] = self[x[i]]
        return [b"".join(x) for x in found]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Each document's ids and an end id, cut into pieces of at most `capacity` ids. tokenizer: a file of the tokenizers library."""
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def load() -> Chunks:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Chunks(Tokenizer.from_str(model.value))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = worker_state(f"chunks_{hash(model.value)}", load)
        out: tuple[list, ...] = ([], [], [], [], [], [])
        for doc, ids in zip(batch.column(0).to_pylist(), known.ids(batch.column(1).to_pylist()), strict=True):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                for column, x in zip(out, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part), np.frombuffer(part, "<u4").astype(np.int32) if with_ids else None), strict=True):
                    column.append(x)
        arrays = [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())), strict=True)]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        return pa.RecordBatch.from_arrays(arrays[: 5 + with_ids], names[: 5 + with_ids])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), cut, PIECES + ", ids array<int>" * with_ids)


def packed_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(written(token_pieces(docs, tokenizer, capacity), "pieces"), ["doc_id", "piece"], capacity)


def packed_sequences(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The sequences themselves: sequence_id, input_ids, doc_ids (in order of their places). No group has more than `capacity` ids."""
    placed = pack(written(token_pieces(docs, tokenizer, capacity, with_ids=True), "pieces"), ["doc_id", "piece"], capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (
        placed.groupBy("sequence_id").agg(parts.alias("parts"))
        .select("sequence_id", F.flatten("parts.ids").alias("input_ids"), F.col("parts.doc_id").alias("doc_ids"))
    )


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mnemosieve.llm.common import read_table

    return packed_documents(read_table(spark, sf_dir, "documents"))
