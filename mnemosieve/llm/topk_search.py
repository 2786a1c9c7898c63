"""Exact top-k inner-product search by the three-phase uniform threshold.

The lists are blocks of dimensions: a score is the sum of its partial products over the blocks. Phase 1: each task goes through its rows once and gathers
its local lists. As soon as it knows k scores of a query, the least of them is its threshold: a score that reaches it needs a partial product of
threshold / blocks in some block, so only entries above that are looked at, and only those are summed up exactly. A task's lists, k entries a query
at most, go to the shared folder. Phase 2: the k-th best of all lists is a score that k rows reach, a safe cutoff, which is broadcast; only list
entries that reach it are collected. Phase 3: ties and ranks of what remains are resolved. Rows are read once, and phase 2 reads lists only.

Queries come in blocks of a bounded size, one pass over the rows for each; only such a block and its cutoffs are ever broadcast. Products are of integers and exact:
32-bit floats hold them below 2**24, 64-bit floats below 2**53, Python integers beyond.

Defined results: a vector that is null or empty or holds a null or non-finite component takes no part; only vectors of the query's length
are compared with it; ties go to the smaller vec_id; a score beyond 64 bits counts as the largest or smallest long; repeated rows are candidates of their own, but a row with the query's vec_id is no
candidate for it; a repeated query id is asked once, with the smallest of its vectors that take part; fewer candidates than k give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mnemosieve.llm.common import BATCH_ROWS, read_table, scratch_path, valid_vector, written

#: Queries of a pass, which a task holds, and their bytes at most; queries of a tile, whose products with a batch of rows it holds at once.
K, BLOCKS, QUERY_BLOCK, QUERY_BYTES, TILE, SCALE = 5, 4, 16_384, 32 << 20, 1024, 256
FOUND = "query_id long, vec_id long, score long"


def quantised(batch: pa.RecordBatch, scale: int = SCALE) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: ids and rows of floor(scale * x), of the vectors that take part."""
    ids = batch.column(0)
    vectors = batch.column(1)
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    lengths = np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, lengths) if ids.null_count else lengths
    offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = {}
    for d in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == d)
        rows = flat[offsets[at][:, None] + np.arange(d)]
        fine = np.isfinite(rows).all(1)
        if fine.any():
            out[int(d)] = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)[at[fine]], np.floor(scale * rows[fine])
    return out


def partials(queries: np.ndarray, rows: np.ndarray, blocks: int) -> list[np.ndarray]:
    """For each block of dimensions, the partial products of all queries and rows, exact."""
    d = rows.shape[1]
    most = d * max(1.0, np.abs(queries).max()) * max(1.0, np.abs(rows).max())
    if most < 2**53:
        kind = np.float32 if most < 2**24 else np.float64
        cast = lambda x: x.astype(kind)
    else:
        cast = lambda x: np.array([[int(v) for v in r] for r in x], object)
    q, x = cast(queries), cast(rows)
    return [q[:, part] @ x[:, part].T for part in np.array_split(np.arange(d), min(blocks, d))]


LEAST = np.iinfo(np.int64).min


def as_long(scores: np.ndarray) -> np.ndarray:
    """Exact scores as 64-bit integers; one beyond them counts as the largest or smallest."""
    if scores.dtype == object:
        scores = np.clip(scores, int(LEAST) + 1, -int(LEAST) - 1)
    return scores.astype(np.int64)


class Lists:
    """A task's best entries for each of its queries: at most k, by score and then by vec_id."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, blocks: int) -> None:
        self.ids, self.queries, self.k, self.blocks = ids, queries, k, blocks
        self.threshold = np.full(len(ids), LEAST)
        self.query, self.vec, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.resolved = 0  # entries that were summed up

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        found = [self.enough(at, ids, rows) for at in range(0, len(self.ids), TILE)]
        query, vec, score = (np.concatenate([old, *(x[c] for x in found)]) for c, old in enumerate((self.query, self.vec, self.score)))
        order = np.lexsort((vec, -score, query))
        query, vec, score = query[order], vec[order], score[order]
        first = np.searchsorted(query, query)
        stays = np.arange(len(query)) - first < self.k
        self.query, self.vec, self.score = query[stays], vec[stays], score[stays]
        full = np.flatnonzero(np.arange(len(self.query)) - np.searchsorted(self.query, self.query) == self.k - 1)
        self.threshold[self.query[full]] = self.score[full]

    def enough(self, at: int, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entries of one tile of queries that reach their thresholds: number of the query, vec_id, score."""
        parts = partials(self.queries[at : at + TILE], rows, self.blocks)
        threshold = self.threshold[at : at + TILE]
        limit = threshold.astype(np.float64)
        limit -= np.abs(limit) * 1e-9 + 1  # below the threshold, whatever rounding does
        limit = (limit / len(parts))[:, None]
        enough = parts[0] >= limit
        for p in parts[1:]:
            enough |= p >= limit
        enough &= self.ids[at : at + TILE, None] != ids[None]
        open_ = threshold == LEAST
        if open_.any() and rows.shape[0] > self.k + 1:  # nothing is known of these queries: of this batch, only the k best and what ties with them
            total = sum((p[open_] for p in parts[1:]), parts[0][open_])
            own = self.ids[at : at + TILE][open_, None] == ids[None]
            least = np.sort(np.where(own, total.min() - 1 if total.dtype != object else min(map(min, total)) - 1, total), 1)[:, -self.k]
            enough[open_] &= total >= least[:, None]
        i, j = np.nonzero(enough)
        self.resolved += len(i)
        score = as_long(sum((p[i, j] for p in parts[1:]), parts[0][i, j]))
        stays = score >= threshold[i]
        return i[stays] + at, ids[j[stays]], score[stays]


def phase_one(queries: dict[int, tuple[np.ndarray, np.ndarray]], k: int, blocks: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's lists over all its rows."""
    lists = {d: Lists(ids, rows, k, blocks) for d, (ids, rows) in queries.items()}
    for batch in batches:
        for d, (ids, rows) in quantised(batch).items():
            if d in lists:
                lists[d].add(ids, rows)
    for x in lists.values():
        if len(x.query):
            yield pa.RecordBatch.from_arrays([pa.array(x.ids[x.query]), pa.array(x.vec), pa.array(x.score)], ["query_id", "vec_id", "score"])


def top_k(rows: DataFrame, queries: DataFrame, k: int = K, blocks: int = BLOCKS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k rows of the largest inner product for each query: query_id, rank, vec_id, score. Both inputs: vec_id, embedding."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    asked = written(queries.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & valid_vector(F.col("embedding"))).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "queries")
    count, longest = asked.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    n = -(-count // max(1, min(query_block, QUERY_BYTES // (8 * max(1, longest)))))
    path = scratch_path(spark, "top-k")
    for block in range(n):  # about query_block queries each
        table = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == block).toArrow().combine_chunks()
        batches = table.to_batches()
        if not batches or not (held := quantised(batches[0])):
            continue
        sent = spark.sparkContext.broadcast(held)
        lists = written(rows.mapInArrow(lambda it, sent=sent: phase_one(sent.value, k, blocks, it), FOUND), "lists")
        by_score, place = Window.partitionBy("query_id").orderBy(F.desc("score")), Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        cutoffs = lists.withColumn("r", F.row_number().over(by_score)).where(F.col("r") == k).select("query_id", F.col("score").alias("cutoff"))  # one for each query of the block
        sufficient = lists.join(F.broadcast(cutoffs), "query_id", "left").where("cutoff is null or score >= cutoff")
        sufficient.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
        sent.destroy()
    schema = "query_id long, rank int, vec_id long, score long"
    if n and spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where("vec_id % 50 = 0"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM s
) WHERE rank <= 5
"""
