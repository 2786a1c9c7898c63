"""Vector codes: each part of a vector is replaced by the number of the nearest entry of the part's codebook, found by Elkan's form of Lloyd's rounds.

A component becomes floor(256 * x); a vector is cut into PARTS consecutive parts, each with a codebook of ENTRIES, which begins with the parts of the rows
of the smallest ids. A round assigns every part and sets an entry to the floor of its parts' mean. Between rounds a table keeps, for every row and part, the
assigned entry, an upper bound of its distance and one lower bound for each entry. When entries have moved, upper bounds grow by the movement of the assigned
entry and lower bounds shrink by that of theirs. An entry is looked at only if neither its lower bound nor half its distance to the assigned one is strictly
above the upper bound; what is looked at is compared by exact squared distances in integers, ties to the lower number. So pruning never decides a tie.

A lower bound is a byte, in steps of a part's own, rounded down; an upper bound is a 32-bit float, rounded up: PARTS * (ENTRIES + 5) bytes a row, which
is more than the vector itself. A round's table is the next one's input, and no key is shuffled: sums of parts are merged by treeAggregate.

Defined results: a vector that is null or empty, or holds a null or non-finite component, takes no part; vectors of different lengths have codebooks of their
own; where PARTS doesn't divide the length, the first parts are one component longer; a repeated vec_id gives its smallest vector to a codebook once, and null ids
come last; fewer ids than ENTRIES give fewer entries; entries may be equal, then the later ones stay unused and as they are; repeated rows are coded
each; components beyond 2**27 are computed with Python's integers, and held within 2**62; an error beyond 64 bits counts as the largest long; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemosieve.llm.common import attach_groups, read_table, scale_floored, tree_sum, valid_vector, vector_rows, written

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
LARGEST, SMALL = float(1 << 62), float(1 << 27)
#: Relative room for rounding of 64-bit distances, and of bounds kept in 32 bits.
ROOM, ROOM_32 = 1e-9, 1e-6
STEPS, MOST = 255, (1 << 63) - 1


def above(distance: np.ndarray) -> np.ndarray:
    return distance * (1 + ROOM) + ROOM


def below(distance: np.ndarray) -> np.ndarray:
    return np.maximum(distance * (1 - ROOM) - ROOM, 0)


def root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


@dataclass
class Codebooks:
    """For each part its entries, in integers; `moved`: how far an entry came in the last round; `steps`: of the lower bounds. cuts: where parts begin and end."""

    cuts: list[tuple[int, int]]
    entries: list[np.ndarray]
    moved: list[np.ndarray]
    steps: list[float]

    @property
    def exact(self) -> bool:
        return self.entries[0].dtype == object

    def between(self, p: int) -> np.ndarray:
        """Half the distances between the entries of a part, rounded down."""
        c = self.entries[p]
        return below(root(((c[:, None] - c[None]) ** 2).sum(2)) / 2)

    def after(self, sums: list[np.ndarray], counts: np.ndarray) -> Codebooks:
        """The next round's: the floor of the mean of what an entry was given; unused entries stay."""
        entries, moved = [], []
        for old, s, n in zip(self.entries, sums, counts, strict=True):
            mean = [[int(v) // int(k) for v in row] if k else list(o) for row, k, o in zip(s, n, old, strict=True)]
            entries.append(np.array(mean, old.dtype).reshape(old.shape))
            moved.append(above(root(((entries[-1] - old) ** 2).sum(1))))
        return Codebooks(self.cuts, entries, moved, self.steps)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for c in self.entries for v in c.ravel()).encode()).hexdigest()

    def table(self, spark: SparkSession) -> DataFrame:
        """part, entry, components."""
        rows = [(p, i, [int(v) for v in row]) for p, c in enumerate(self.entries) for i, row in enumerate(c)]
        return spark.createDataFrame(rows, "part int, entry int, components array<long>")


def first_books(vectors: np.ndarray, parts: int) -> Codebooks:
    """Codebooks that begin with the parts of the given rows."""
    edges = np.cumsum([0, *(len(x) for x in np.array_split(np.arange(vectors.shape[1]), parts))]).tolist()
    cuts = list(zip(edges[:-1], edges[1:], strict=True))
    entries = [vectors[:, a:b] for a, b in cuts]
    books = Codebooks(cuts, entries, [np.zeros(len(vectors)) for _ in cuts], [1.0] * parts)
    books.steps = [max(float(books.between(p).max(initial=0)) * 2, 1.0) / STEPS for p in range(parts)]
    return books


def integers(x: np.ndarray, exact: bool) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape) if exact else x.astype(np.int64)


@dataclass
class Bounds:
    """Of a batch: assigned (rows x parts), upper (rows x parts), lower (rows x parts x entries, in steps). seen: squared distances that were computed."""

    assigned: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    seen: int = 0


def assign_all(books: Codebooks, x: np.ndarray) -> Bounds:
    """The first assignment: all distances, from which the bounds come."""
    m, parts, k = len(x), len(books.cuts), len(books.entries[0])
    out = Bounds(np.zeros((m, parts), np.uint8), np.zeros((m, parts), np.float32), np.zeros((m, parts, k), np.uint8), m * parts * k)
    for p, (a, b) in enumerate(books.cuts):
        square = ((x[:, None, a:b] - books.entries[p][None]) ** 2).sum(2)
        best = square.argmin(1)
        out.assigned[:, p] = best
        out.upper[:, p] = above(root(square[np.arange(m), best])) * (1 + ROOM_32)
        out.lower[:, p] = in_steps(root(square), books.steps[p])
    return out


def in_steps(distance: np.ndarray, step: float) -> np.ndarray:
    return np.minimum(below(distance) / step, STEPS).astype(np.uint8)


def assign_again(books: Codebooks, x: np.ndarray, old: Bounds) -> Bounds:
    """The assignment after entries have moved: only entries that the bounds don't rule out are looked at."""
    m, k = len(x), len(books.entries[0])
    out = Bounds(old.assigned.copy(), old.upper.copy(), old.lower.copy())
    for p, (begin, end) in enumerate(books.cuts):
        part, c, step, half = x[:, begin:end], books.entries[p], books.steps[p], books.between(p)
        a = old.assigned[:, p].astype(np.int64)
        upper = above(old.upper[:, p] + books.moved[p][a])
        lower = np.maximum(np.floor(old.lower[:, p] - books.moved[p] * (1 + ROOM) / step - ROOM), 0)
        floor = np.maximum(lower * step * (1 - ROOM), half[a])
        floor[np.arange(m), a] = np.inf  # the assigned entry is computed apart
        open_ = np.flatnonzero((floor <= upper[:, None]).any(1))
        if len(open_):
            own = ((part[open_] - c[a[open_]]) ** 2).sum(1)
            upper[open_] = above(root(own))
            i, j = np.nonzero(floor[open_] <= upper[open_, None])
            square = ((part[open_[i]] - c[j]) ** 2).sum(1)
            out.seen += len(open_) + len(i)
            table = np.full((len(open_), k), None if books.exact else MOST, object if books.exact else np.int64)
            if books.exact:
                table[:] = max([*own, *square]) + 1
            table[np.arange(len(open_)), a[open_]] = own
            table[i, j] = square
            best = table.argmin(1)
            out.assigned[open_, p] = best
            upper[open_] = above(root(table[np.arange(len(open_)), best]))
            lower[open_[i], j] = in_steps(root(square), step)
            lower[open_, a[open_]] = in_steps(root(own), step)
        out.upper[:, p] = upper * (1 + ROOM_32)
        out.lower[:, p] = lower
    return out


def errors(books: Codebooks, x: np.ndarray, assigned: np.ndarray) -> np.ndarray:
    """Squared distances to the assigned entries, summed over parts."""
    total = sum(((x[:, a:b] - books.entries[p][assigned[:, p]]) ** 2).sum(1) for p, (a, b) in enumerate(books.cuts))
    return np.array([min(int(v), MOST) for v in total], np.int64) if books.exact else total


def bytes_rows(column: pa.Array, shape: tuple[int, ...], kind: str) -> np.ndarray:
    """A binary column whose values all have the bytes of this shape."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].view(kind).reshape(len(column), *shape)


def as_bytes(rows: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(rows)
    each = data.nbytes // len(data)
    return pa.BinaryArray.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(np.arange(len(data) + 1, dtype=np.int32) * each), pa.py_buffer(data)])


STATE = ["assigned", "upper", "lower"]


def assigned(rows: DataFrame, books: Codebooks, last: bool) -> DataFrame:
    """rows (_x, _own and, after the first round, the state) with the state of this round; at last with code and error instead."""
    sent, again = rows.sparkSession.sparkContext.broadcast(books), "assigned" in rows.columns
    names = ["_own", "code", "error"] if last else ["_x", "_own", *STATE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        parts, k = len(books.cuts), len(books.entries[0])
        for batch in batches:
            if not batch.num_rows:
                continue
            x = integers(vector_rows(batch.column(0)), books.exact)
            if again:
                old = Bounds(bytes_rows(batch.column(2), (parts,), "u1"), bytes_rows(batch.column(3), (parts,), "<f4"), bytes_rows(batch.column(4), (parts, k), "u1"))
                new = assign_again(books, x, old)
            else:
                new = assign_all(books, x)
            if last:
                out = [batch.column(1), as_bytes(new.assigned), pa.array(errors(books, x, new.assigned))]
            else:
                out = [batch.column(0), batch.column(1), as_bytes(new.assigned), as_bytes(new.upper.astype("<f4")), as_bytes(new.lower)]
            yield pa.RecordBatch.from_arrays(out, names)

    rows = rows.select("_x", "_own", *(STATE if again else []))
    more = {"code": F.lit(b""), "error": F.lit(0).cast("long")} if last else {c: F.lit(b"") for c in STATE}
    return rows.mapInArrow(run, rows.select(*(c for c in names if c in ("_x", "_own")), *(v.alias(c) for c, v in more.items())).schema)


def part_sums(state: DataFrame, books: Codebooks) -> tuple[list[np.ndarray], np.ndarray]:
    """What the entries were given: for each part the sums (entries x width), and the counts (parts x entries). Exact."""
    parts, k = len(books.cuts), len(books.entries[0])
    d = books.cuts[-1][1]

    def of_batch(batch: pa.RecordBatch) -> np.ndarray:
        x, a = integers(vector_rows(batch.column(0)), books.exact), bytes_rows(batch.column(1), (parts,), "u1")
        total = np.zeros((k, d + parts), x.dtype)
        for p, (begin, end) in enumerate(books.cuts):
            np.add.at(total[:, begin:end], a[:, p], x[:, begin:end])
            total[:, d + p] = np.bincount(a[:, p], minlength=k)
        return total.astype(object)

    total = tree_sum(state.select("_x", "assigned"), of_batch, np.zeros((k, d + parts), object))
    return [total[:, a:b] for a, b in books.cuts], total[:, d:].T


def seeds(vectors: DataFrame, entries: int) -> np.ndarray:
    """The vectors of the smallest ids, one of each."""
    ids = [r[0] for r in vectors.select("_id").distinct().orderBy(F.asc_nulls_last("_id")).limit(entries).collect()]
    chosen = vectors.where(F.col("_id").isin([i for i in ids if i is not None]) | (F.col("_id").isNull() & F.lit(None in ids)))
    return np.array([r["x"] for r in chosen.groupBy("_id").agg(F.min("_x").alias("x")).orderBy(F.asc_nulls_last("_id")).collect()])


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """_own, code (a byte a part) and error for each row of vectors (_id, _x, _own; one length, at least one row, a written table), and the codebooks."""
    most = vectors.select(F.max(F.array_max(F.transform("_x", F.abs)))).first()[0]
    books = first_books(integers(seeds(vectors, entries), most >= SMALL), parts)
    state = vectors
    for _ in range(rounds):
        state = written(assigned(state, books, last=False), "code-bounds")
        books = books.after(*part_sums(state, books))
    return assigned(state, books, last=True), books


def compressed(rows: DataFrame, column: str = "embedding", key: str = "vec_id", keep: tuple[str, ...] = ("vec_id", "label"), parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """keep, code (binary), error and codebooks_sha256 for each row whose vector takes part."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte a part")
    chosen = rows.where(valid_vector(F.col(f"`{column}`"))).select(F.col(f"`{key}`").alias("_id"), scale_floored(F.col(f"`{column}`"), SCALE, LARGEST).alias("_x"), F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_own"))
    vectors = written(chosen, "code-vectors")
    out = []
    for d in sorted(r[0] for r in vectors.select(F.size("_x")).distinct().collect()):  # in an embedding table, one
        coded, books = compress(vectors.where(F.size("_x") == d), parts, entries, rounds)
        out.append(coded.withColumn("codebooks_sha256", F.lit(books.sha256())))
    if not out:
        out = [vectors.select("_own", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"), F.lit("").alias("codebooks_sha256"))]
    found = out[0]
    for x in out[1:]:
        found = found.unionByName(x)
    return found.select(*(F.col("_own").getField(c).alias(c) for c in keep), "code", "error", "codebooks_sha256")


def with_label_error(coded: DataFrame) -> DataFrame:
    """coded (label, error and others; a cheap input) with label_error, the sum of error over equal labels, nulls together."""
    by = ["_none", "_label"]
    coded = coded.withColumn("_none", F.col("label").isNull()).withColumn("_label", F.coalesce(F.col("label").cast("string"), F.lit("")))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long")
    groups = written(coded.groupBy(*by).agg(total.alias("label_error"), F.count(F.lit(1)).alias("_n")), "label-errors")
    return attach_groups(coded, groups, by, "_n").drop(*by, "_n")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = written(compressed(read_table(spark, sf_dir, "embeddings")), "codes")
    return with_label_error(coded).select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256")


_NEAREST = """
  SELECT rid, part, arg_min(entry, d2 * 64 + entry) AS entry, min(d2) AS d2 FROM (
    SELECT p.rid, p.part, c.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i])))::BIGINT AS d2 FROM p JOIN {c} c USING (part)
  ) GROUP BY rid, part
"""
_NEXT = """
  SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM {c} c LEFT JOIN (
    SELECT part, entry, list(v ORDER BY i) AS x FROM (
      SELECT part, a.entry, i, floor(sum(p.x[i])::DOUBLE / count(*))::BIGINT AS v FROM {a} a JOIN p USING (rid, part), range(1, 5) t(i) GROUP BY part, a.entry, i
    ) GROUP BY part, entry
  ) m USING (part, entry)
"""
ORACLE_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT rid, vec_id, part, list_slice(e, part * len(e) // 16 + 1, (part + 1) * len(e) // 16) AS x FROM v, range(0, 16) t(part)
), c0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p
  WHERE vec_id IN (SELECT DISTINCT vec_id FROM v ORDER BY vec_id LIMIT 64)
), a0 AS MATERIALIZED ({_NEAREST.format(c="c0")}), c1 AS MATERIALIZED ({_NEXT.format(c="c0", a="a0")}),
a1 AS MATERIALIZED ({_NEAREST.format(c="c1")}), c2 AS MATERIALIZED ({_NEXT.format(c="c1", a="a1")}),
a2 AS MATERIALIZED ({_NEAREST.format(c="c2")}),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2),
r AS (SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d2)::BIGINT AS error FROM a2 GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM r JOIN v USING (rid), h
"""
