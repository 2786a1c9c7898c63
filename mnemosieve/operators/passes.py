"""Passes over a corpus that score every document against a block of queries and keep little of it.

A score is a cosine in 32 bits (0 without a vector on either side, or of another length), plus the boost where the document is in the query's pool. Tasks score
their documents in batches against all queries of a block; what leaves a task is either the first documents of each query or, for a few marked
documents of each query, how many stand before them. So ranks in the whole corpus come without a row for every document and query.

A block has QUERY_BLOCK queries at most: its vectors and marks are all that is broadcast, and a block takes a pass of its own over the documents. A query's
documents go by score and then by id; a score that isn't a number takes no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import deepcopy
from dataclasses import dataclass
from functools import cached_property, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemosieve.sources.tables import written

#: Queries that a task scores its documents against at once, and documents at once.
QUERY_BLOCK, DOC_BATCH = 4096, 1000


def dots_f32(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products (rows x queries) in 32 bits, products rounded and summed strictly from left to right."""
    out = np.zeros((len(rows), len(queries)), np.float32)
    for i in range(rows.shape[1]):
        out += rows[:, i, None] * queries[None, :, i]
    return out


class First:
    """The first `limit` documents of each query, by score and then by id, of those that a task has come by."""

    def __init__(self, queries: int, limit: int) -> None:
        self.limit, self.least = limit, np.full(queries, -np.inf)
        self.query, self.doc, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, docs: np.ndarray, scores: np.ndarray, passing: np.ndarray | None = None) -> None:
        """scores, passing: documents x queries."""
        scores = np.where(np.isnan(scores) if passing is None else np.isnan(scores) | ~passing, -np.inf, scores)
        least = self.least
        if len(docs) > self.limit:
            least = np.maximum(least, np.partition(scores, len(docs) - self.limit, 0)[len(docs) - self.limit])
        i, q = np.nonzero((scores >= least) & (scores > -np.inf))
        query, doc, score = np.concatenate([self.query, q]), np.concatenate([self.doc, docs[i]]), np.concatenate([self.score, scores[i, q]])
        order = np.lexsort((doc, -score, query))
        query, doc, score = query[order], doc[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        stays = place < self.limit
        self.query, self.doc, self.score = query[stays], doc[stays], score[stays]
        last = place[stays] == self.limit - 1
        self.least[self.query[last]] = self.score[last]

    def rows(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.query.astype(np.int32)), pa.array(self.doc), pa.array(self.score)], ["_q", "doc_id", "score"])


class Before:
    """For the marked documents of each query, how many of those that a task has come by stand before them, and how many of these don't pass."""

    def __init__(self, marks: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """marks: queries, documents and scores of the first mark of each query, of the second, and so on."""
        self.marks, self.counts = marks, [np.zeros((2, len(q)), np.int64) for q, _, _ in marks]

    def add(self, docs: np.ndarray, scores: np.ndarray, passing: np.ndarray | None = None) -> None:
        for (query, doc, score), count in zip(self.marks, self.counts, strict=True):
            mine = scores[:, query]
            before = (mine > score) | ((mine == score) & (docs[:, None] < doc))
            count[0] += before.sum(0)
            if passing is not None:
                count[1] += (before & ~passing[:, query]).sum(0)

    def rows(self) -> pa.RecordBatch:
        query, doc = (np.concatenate([m[k] for m in self.marks]) if self.marks else np.zeros(0, np.int64) for k in (0, 1))
        count = np.concatenate(self.counts, 1) if self.counts else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(doc.astype(np.int64)), pa.array(count[0]), pa.array(count[1])], ["_q", "doc_id", "before", "barred"])


#: Numbers of queries that any document passes, or none.
ANY, NONE = -1, -3


class Block(NamedTuple):
    """Queries of a pass as a task holds them. project: a number for each, ANY or NONE."""

    vectors: np.ndarray
    known: np.ndarray
    project: np.ndarray
    projects: dict[str, int]


def scored(block: Block, batch: pa.RecordBatch, weight: float, digits: int | None) -> np.ndarray:
    """Scores, documents x queries, of a batch of doc_id, vec, _qs, _coverages."""
    sizes = pc.fill_null(pc.list_value_length(batch.column(1)), -1).to_numpy(zero_copy_only=False)
    own = np.flatnonzero(sizes == block.vectors.shape[1])
    vectors = pc.take(batch.column(1), pa.array(own)).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(own), block.vectors.shape[1])
    score = np.zeros((batch.num_rows, len(block.vectors)), np.float32)
    if block.vectors.shape[1]:
        score[own] = np.where(block.known, dots_f32(vectors, block.vectors), np.float32(0))
    member = pc.fill_null(pc.list_value_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
    i, q = np.repeat(np.arange(batch.num_rows), member), batch.column(2).flatten().to_numpy(zero_copy_only=False)
    score[i, q] += (weight * batch.column(3).flatten().to_numpy(zero_copy_only=False)).astype(np.float32)
    exact = score.astype(np.float64)
    return exact if digits is None else np.sign(exact) * np.floor(np.abs(exact) * 10.0**digits + 0.5) / 10.0**digits


@dataclass
class Passes:
    """docs: doc_id and, where queries name projects, project. vectors: doc_id, vec. queries: query_id, vec and, optionally, project: which documents
    pass ('' any, null none). members: query_id, doc_id, coverage of the pools. digits: places to which scores are rounded before they are compared.
    passing: which documents there are at all. once: one pass is to come, so documents and vectors aren't written for a second."""

    docs: DataFrame
    vectors: DataFrame
    queries: DataFrame
    members: DataFrame
    weight: float
    digits: int | None = None
    passing: Column | None = None
    once: bool = False

    @cached_property
    def asked(self) -> DataFrame:
        project = F.col("project") if "project" in self.queries.columns else F.lit("")
        return written(self.queries.select("query_id", F.col("vec").cast("array<float>").alias("vec"), project.alias("project")), "pass-queries")

    @cached_property
    def rows(self) -> DataFrame:
        project = F.col("project") if "project" in self.docs.columns else F.lit("")
        docs = self.docs if self.passing is None else self.docs.where(self.passing)
        out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), project.alias("project")).join(self.vectors.select("doc_id", F.col("vec").cast("array<float>").alias("vec")), "doc_id", "left")
        return out if self.once else written(out, "pass-rows")

    @cached_property
    def pools(self) -> DataFrame:
        members = self.members.select("query_id", F.col("doc_id").cast("long").alias("doc_id"), F.col("coverage").cast("double").alias("coverage"))
        return members if self.once else written(members, "pass-members")

    def blocks(self) -> Iterator[tuple[Block, DataFrame]]:
        """Blocks of queries, each with the numbers of its queries: _q, query_id."""
        spark, n = self.asked.sparkSession, max(1, -(-self.asked.count() // QUERY_BLOCK))
        for k in range(n):
            rows = (self.asked.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == k) if n > 1 else self.asked).orderBy("query_id").collect()
            if not rows:
                continue
            names = spark.createDataFrame([(i, r["query_id"]) for i, r in enumerate(rows)], f"_q int, query_id {self.asked.schema['query_id'].dataType.simpleString()}")
            d = max((len(r["vec"]) for r in rows if r["vec"] is not None), default=0)
            known = np.array([r["vec"] is not None and len(r["vec"]) == d for r in rows])
            vectors = np.array([r["vec"] if fine else [0.0] * d for r, fine in zip(rows, known, strict=True)], np.float32).reshape(len(rows), d)
            projects = {p: i for i, p in enumerate(sorted({r["project"] for r in rows} - {"", None}))}
            yield Block(vectors, known, np.array([({"": ANY, None: NONE} | projects)[r["project"]] for r in rows]), projects), names

    def joined(self, rows: DataFrame, names: DataFrame, *others: str) -> DataFrame:
        """rows with the block's queries in whose pools a document is: doc_id, vec, _qs, _coverages and others."""
        named = self.pools.join(F.broadcast(names), "query_id").groupBy("doc_id")  # as many as a block's queries at most
        gains = named.agg(F.collect_list("_q").alias("_qs"), F.collect_list("coverage").alias("_coverages"))
        return rows.join(gains, "doc_id", "left").select("doc_id", "vec", "_qs", "_coverages", *others)

    def run(self, block: Block, names: DataFrame, empty: First | Before, schema: str, any_project: bool = False) -> DataFrame:
        """What each task holds after all its documents; empty: what it begins with. any_project: every document passes every query."""
        rows, weight, digits = self.joined(self.rows, names, "project"), self.weight, self.digits
        sent = rows.sparkSession.sparkContext.broadcast((block, empty))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, kept = sent.value[0], deepcopy(sent.value[1])  # a worker's tasks share what was sent
            for whole in batches:
                for at in range(0, whole.num_rows, DOC_BATCH):
                    batch = whole.slice(at, DOC_BATCH)
                    passing = None
                    if not any_project and (block.project != ANY).any():
                        mine = np.array([block.projects.get(p, -2) for p in batch.column(4).to_pylist()])
                        passing = (block.project == ANY) | (mine[:, None] == block.project)
                    kept.add(batch.column(0).to_numpy(zero_copy_only=False), scored(block, batch, weight, digits), passing)
            out = kept.rows()
            if out.num_rows:
                yield out

        return rows.mapInArrow(task, schema).join(F.broadcast(names), "_q").drop("_q")

    def leading(self, limit: int, any_project: bool = False) -> DataFrame:
        """query_id, doc_id, score, place of the first `limit` documents that pass."""
        found = [self.run(block, names, First(len(block.vectors), limit), "_q int, doc_id long, score double", any_project) for block, names in self.blocks()]
        if not found:
            return self.asked.select("query_id", F.lit(0).cast("long").alias("doc_id"), F.lit(0.0).alias("score"), F.lit(0).alias("place")).limit(0)
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
        return reduce(DataFrame.unionByName, found).withColumn("place", place).where(F.col("place") <= limit).select("query_id", "doc_id", "score", "place")

    def scores_of(self, pairs: DataFrame) -> DataFrame:
        """query_id, doc_id, score of some pairs (query_id, doc_id): only their documents are scored."""
        weight, digits, found = self.weight, self.digits, []
        for block, names in self.blocks():
            wanted = pairs.join(F.broadcast(names), "query_id").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.collect_set("_q").alias("_wanted"))
            rows, sent = self.joined(self.rows.join(wanted, "doc_id"), names, "_wanted"), pairs.sparkSession.sparkContext.broadcast(block)

            def task(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
                for whole in batches:
                    for at in range(0, whole.num_rows, DOC_BATCH):
                        batch = whole.slice(at, DOC_BATCH)
                        i = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(4)).to_numpy(zero_copy_only=False))
                        q = batch.column(4).flatten().to_numpy(zero_copy_only=False)
                        ids = batch.column(0).to_numpy(zero_copy_only=False)[i]
                        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(ids), pa.array(scored(sent.value, batch, weight, digits)[i, q])], ["_q", "doc_id", "score"])

            found.append(rows.mapInArrow(task, "_q int, doc_id long, score double").where(~F.isnan("score")).join(F.broadcast(names), "_q").drop("_q"))
        return reduce(DataFrame.unionByName, found) if found else pairs.select("query_id", "doc_id", F.lit(0.0).alias("score")).limit(0)

    def before(self, marks: DataFrame) -> DataFrame:
        """query_id, doc_id, before, barred of marked documents (query_id, doc_id, score; a table, a few for each query): how many documents, passing or not, stand
        before it, and how many of these don't pass."""
        found = []
        for block, names in self.blocks():
            held = marks.join(F.broadcast(names), "query_id").select("_q", "doc_id", "score").orderBy("_q", F.desc("score"), "doc_id").toArrow()
            query, doc, score = (held.column(k).to_numpy() for k in range(3))
            place = np.arange(len(query)) - np.searchsorted(query, query)
            columns = [(query[at], doc[at], score[at]) for k in range(int(place.max(initial=-1)) + 1) for at in [place == k]]
            found.append(self.run(block, names, Before(columns), "_q int, doc_id long, before long, barred long"))
        if not found:
            return marks.select("query_id", "doc_id", F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("barred")).limit(0)
        return reduce(DataFrame.unionByName, found).groupBy("query_id", "doc_id").agg(F.sum("before").alias("before"), F.sum("barred").alias("barred"))
