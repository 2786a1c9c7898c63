"""Quality by nearest-neighbour voting over latent-semantic vectors.

A document is a bag of terms: the shape of each word (runs of letter case, digits and punctuation), its first bytes, and binned traits of the
whole text (share of repeated words and lines, of capitals, of symbols, mean lengths). Every text is read once and written as its sparse terms; document
frequencies and the terms' Gram matrix are summed over all documents, in whole numbers, so they don't depend on how the documents are dealt to tasks.
Weighted by tf-idf and projected on the leading singular vectors, a document is a latent-semantic vector. Labelled vectors, a bounded number, are
broadcast; every document's cosine with each of them is computed exactly, in blocks, and the nearest vote with their similarity as weight.

Sample: LABELLED_DOCS labelled documents for the vote, those with the smallest hashes of doc_id.

Defined results: null counts as empty; an empty text is a document without words, judged by its neighbours like any other; repeated rows score
alike; ties among neighbours go by doc_id; without labelled documents the score is 0.5; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemosieve.llm.common import WordHasher, arrow_map, bytes_of, read_table, worker_state, written
from mnemosieve.llm.folds import fold, labelled, sample_ids

LABELLED_DOCS = 8000
FOLDS, HELD_OUT = 3, 1
SHAPES, STEMS, TRAITS, BINS = 512, 384, 8, 16
TERMS = SHAPES + STEMS + TRAITS * BINS
LATENT, NEIGHBOURS, POWER, BLOCK = 48, 15, 8, 256
#: Weight of a trait among the terms of a text.
TRAIT_WEIGHT = 3.0
#: Steps of a unit vector's component when the Gram matrix is summed; tasks that sum it at most; rows of it that travel together.
STEPS, SUMMED_BY, GRAM_ROWS = 1 << 12, 1000, 16


class Terms:
    """Weighted term counts of each text of a column."""

    def __init__(self) -> None:
        self.hasher = WordHasher()
        self.kind = np.arange(256, dtype=np.uint8)  # punctuation stands for itself
        self.kind[[*range(97, 123), *range(128, 256)]] = 97
        self.kind[65:91] = 65
        self.kind[48:58] = 48

    def read(self, text: pa.Array) -> np.ndarray:
        n = len(text)
        out = np.zeros((n, TERMS), np.float32)
        word, start, end, first, folded = self.hasher.words(text)
        raw, at = bytes_of(text)
        count = np.diff(first)
        doc = np.repeat(np.arange(n), count)
        if len(start):
            kind = self.kind[raw]
            head = np.zeros(len(raw) + 1, bool)
            head[start] = True
            change = head[:-1].copy()
            change[1:] |= kind[1:] != kind[:-1]
            inside = np.zeros(len(raw) + 1, np.int8)
            np.add.at(inside, start, 1)
            np.add.at(inside, end, -1)
            runs = np.flatnonzero(change & (np.cumsum(inside[:-1]) > 0))
            begins = np.searchsorted(runs, start)
            shape = self.hasher.spans(kind[runs], begins, np.append(begins[1:], len(runs)))
            stem = self.hasher.spans(folded, start, np.minimum(end, start + 3))
            terms = np.bincount(doc * TERMS + (shape % np.uint64(SHAPES)).astype(np.int64), minlength=n * TERMS) + np.bincount(doc * TERMS + SHAPES + (stem % np.uint64(STEMS)).astype(np.int64), minlength=n * TERMS)
            out += np.log1p(terms.reshape(n, TERMS)).astype(np.float32)
        for i, trait in enumerate(self.traits(word, start, end, first, count, doc, raw, at)):
            place = np.clip(trait, 0, 1) * (BINS - 1)  # shared by the two nearest bins, so near values are similar
            low = np.minimum(place.astype(np.int64), BINS - 2)
            column = SHAPES + STEMS + i * BINS + low
            out[np.arange(n), column] += TRAIT_WEIGHT * (1 - (place - low))
            out[np.arange(n), column + 1] += TRAIT_WEIGHT * (place - low)
        return out

    @staticmethod
    def traits(word, start, end, first, count, doc, raw, at) -> list[np.ndarray]:
        """Eight numbers from 0 to 1 for each text."""
        n = len(count)
        some = np.maximum(count, 1)
        same = np.zeros(len(word), bool)
        same[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
        per = lambda flags: np.bincount(doc, flags, n) / some
        order = np.lexsort((word, doc))
        new = np.ones(len(word), bool)
        new[1:] = (word[order][1:] != word[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        distinct = np.bincount(doc[order], new, n) / some
        whole = np.flatnonzero(np.arange(len(word)) - np.repeat(first[:-1], count) >= 3)  # words that end a run of four in their text
        grams, owner = word[whole] * np.uint64(3) ^ word[whole - 1] * np.uint64(5) ^ word[whole - 2] * np.uint64(7) ^ word[whole - 3], doc[whole]
        order = np.lexsort((grams, owner))
        again = np.zeros(len(whole), bool)
        again[1:] = (grams[order][1:] == grams[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        size = np.maximum(np.diff(at), 1)
        total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[at]) / size
        capitals, marks = (raw >= 65) & (raw <= 90), (raw < 128) & ~(((raw >= 65) & (raw <= 90)) | ((raw >= 97) & (raw <= 122)) | (raw <= 32) | ((raw >= 48) & (raw <= 57)))
        return [
            np.minimum(1, 1.5 * per(same)) ** 0.35, distinct, np.sqrt(np.bincount(owner[order], again, n) / some), np.sqrt(total(capitals)), np.sqrt(total(marks)),
            np.bincount(doc, end - start, n) / some / 16, np.log1p(count) / 12, np.sqrt(total((raw >= 48) & (raw <= 57))),
        ]


def in_blocks(x: np.ndarray, function) -> np.ndarray:
    """function over blocks of BLOCK rows, the last filled up: a row's result is the same whatever rows come with it."""
    out = []
    for at in range(0, len(x), BLOCK):
        block = np.zeros((BLOCK, x.shape[1]), x.dtype)
        some = x[at : at + BLOCK]
        block[: len(some)] = some
        out.append(function(block)[: len(some)])
    return np.concatenate(out)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)


def project(counts: np.ndarray, model: dict) -> np.ndarray:
    return in_blocks(counts, lambda x: unit((x * model["weights"]) @ model["basis"]))


def vote(vectors: np.ndarray, model: dict) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors, weighted by a power of the cosine, with a pseudo-vote at the base rate."""
    k = min(NEIGHBOURS, len(model["labels"]))

    def share(x: np.ndarray) -> np.ndarray:
        cosine = x @ model["vectors"].T
        near = np.sort(np.argpartition(cosine, -k, 1)[:, -k:], 1)
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** POWER + 1e-6
        return (weight * model["labels"][near]).sum(1) / weight.sum(1)

    return in_blocks(vectors, share)


def sparse(terms: np.ndarray) -> pa.Array:
    """Each row's terms that aren't 0: numbers of the terms, then their weights, 2 bytes each."""
    row, column = np.nonzero(terms)
    first = np.searchsorted(row, np.arange(len(terms) + 1))
    number, weight = column.astype("<u2"), terms[row, column].astype("<f2")
    return pa.array([number[a:b].tobytes() + weight[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())


def dense(rows: pa.Array) -> np.ndarray:
    out = np.zeros((len(rows), TERMS), np.float32)
    for i, x in enumerate(rows.to_pylist()):
        out[i, np.frombuffer(x, "<u2", len(x) // 4)] = np.frombuffer(x, "<f2", offset=len(x) // 2)
    return out


def represented(docs: DataFrame) -> DataFrame:
    """doc_id and sparse terms of each row, as a table."""
    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), sparse(worker_state("quality_terms", Terms).read(batch.column(1)))], ["doc_id", "terms"])

    return written(arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), read, "doc_id long, terms binary"), "quality-terms")


def term_weights(table: DataFrame) -> np.ndarray:
    """Inverse document frequencies over all documents; traits weigh 1."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(TERMS + 1, np.int64)
        for batch in batches:
            seen[-1] += batch.num_rows
            seen[:-1] += sum(np.bincount(np.frombuffer(x, "<u2", len(x) // 4), minlength=TERMS) for x in batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1)), pa.array(seen)], ["term", "n"])

    seen = np.zeros(TERMS + 1)
    for r in table.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():  # TERMS + 1 rows
        seen[r["term"]] = r["n"]
    return np.where(np.arange(TERMS) < SHAPES + STEMS, np.log((1 + seen[-1]) / (1 + seen[:-1])) + 0.2, 1.0).astype(np.float32)


def latent_basis(table: DataFrame, weights: np.ndarray, latent: int = LATENT) -> np.ndarray:
    """Leading right singular vectors of the weighted, unit-length rows of all documents. Components are rounded to whole STEPS, so that sums over tasks
    are exact in any order."""
    def square(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((TERMS, TERMS))
        for batch in batches:
            x = np.rint(unit(dense(batch.column(0)) * weights).astype(np.float64) * STEPS)
            gram += x.T @ x
        parts = gram.astype("<i8").reshape(-1, GRAM_ROWS * TERMS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts))), pa.array([x.tobytes() for x in parts], pa.binary())], ["part", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(x, "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "sums"])

    schema = "part long, sums binary"
    dealt = table.select("terms")
    if dealt.rdd.getNumPartitions() > SUMMED_BY:
        dealt = dealt.coalesce(SUMMED_BY)
    added = dealt.mapInArrow(square, schema).repartition(TERMS // GRAM_ROWS, "part").mapInArrow(add, schema)
    gram = np.zeros((TERMS // GRAM_ROWS, GRAM_ROWS * TERMS))
    for r in added.collect():  # the matrix, 8 MB
        gram[r["part"]] = np.frombuffer(r["sums"], "<i8")
    _, v = np.linalg.eigh(gram.reshape(TERMS, TERMS) / STEPS**2)
    return v[:, ::-1][:, :latent].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT, labelled_docs: int = LABELLED_DOCS) -> dict | None:
    """Term weights, basis, labelled vectors and their labels: some 2 MB, whatever the corpus. docs: documents, or the table of their terms."""
    table = docs if "terms" in docs.columns and "text" not in docs.columns else represented(docs)
    chosen = sample_ids(written(labelled(labels, label, folds, held_out), "quality-labels"), labelled_docs)
    rows = table.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "terms").collect()  # a bounded number of bounded rows
    if not rows:
        return None
    rows = sorted(rows, key=lambda x: (x["doc_id"], x["terms"]))
    model = {"weights": term_weights(table)}
    model["basis"] = latent_basis(table, model["weights"])
    terms = pa.array([x["terms"] for x in rows], pa.binary())
    vectors = np.concatenate([project(dense(terms[at : at + 1000]), model) for at in range(0, len(rows), 1000)])
    return model | {"vectors": vectors, "labels": np.array([x["label"] for x in rows], np.float64)}


def scored(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id and score, for each row. docs: documents, or the table of their terms."""
    known = "terms" in docs.columns and "text" not in docs.columns
    if model is None:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0.5).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        terms = dense(batch.column(1) if known else sparse(worker_state("quality_terms", Terms).read(batch.column(1))))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(vote(project(terms, sent.value), sent.value))], ["doc_id", "score"])

    if known:
        return docs.select("doc_id", "terms").mapInArrow(lambda batches: (run(x) for x in batches if x.num_rows), "doc_id long, score double")
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, score double")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = represented(read_table(spark, sf_dir, "documents"))
    out = scored(terms, fit(terms, read_table(spark, sf_dir, "labels")))
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
