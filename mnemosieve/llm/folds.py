"""Bounded, reproducible samples of labelled documents, and the held-out folds of the contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo folds; 0 for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def labelled(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """doc_id and label (0 or 1) of the rows that may be learned from; a doc_id that repeats counts once, with its largest label."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    return rows.groupBy("doc_id").agg(F.max("label").alias("label")).where(fold(F.col("doc_id"), folds) != held_out)


def smallest(rows: DataFrame, key: str, most: int) -> DataFrame:
    """`most` rows with the smallest keys, which are hashes of 64 bits and different. rows: a written table or another cheap, stable input.
    A cut by the key leaves some 2 * most rows, so that tasks don't send `most` rows each."""
    n, wanted = rows.count(), 2 * most + 1000
    while n > wanted:
        some = rows.where(F.col(key) < int(-(1 << 63) + (1 << 64) * (wanted / n)))
        if some.count() >= most:
            return some.orderBy(key).limit(most)
        wanted *= 2
    return rows.orderBy(key).limit(most)


def sample_ids(rows: DataFrame, most: int) -> DataFrame:
    """`most` rows with the smallest hashes of doc_id; a doc_id occurs once."""
    return smallest(rows.withColumn("_hash", F.xxhash64("doc_id")), "_hash", most).drop("_hash")


def texts_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id, label and whole text of the chosen (a bounded number); of a repeated doc_id the smallest text."""
    chosen = chosen.select(F.col("doc_id").alias("_id"), "label")
    docs = docs.select("doc_id", "text")
    return docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("_id")).groupBy("doc_id", "label").agg(F.min("text").alias("text"))
