"""Whitening of embeddings by a two-pass covariance.

A component c becomes x = floor(64 * c) + 1000000. The fit list has each distinct x vector once; it is written as a table and read three times: exact integer
sums give the mean; centred outer products (one NumPy product a batch) give the covariance; the whitened fit list is measured against the identity.
Each task gives one partial result, which a treeAggregate merges, so the driver receives a few matrices whatever the number of tasks. LAPACK's symmetric
eigh gives the components, largest eigenvalue first; the projection is broadcast (dimension x COMPONENTS numbers).

Centring is exact up to the last step: x - S // n in integers, then less (S mod n) / n. The whitened list needs no centring of its own, as its mean is a
projection of exactly zero. Vectors with the same x are collapsed before they are shuffled, so a vector that repeats however often is one row of a task.

Defined results: a vector that is null or empty, or holds a null or non-finite component, takes no part; vectors of different lengths are whitened apart, each
length with a list, a mean and components of its own; repeated rows and ids give rows each; a null vec_id is kept; there are as many components as
dimensions, COMPONENTS at most; a component without variance (below TINY of the largest eigenvalue) has whitened 0 and takes no part in identity_error; x is held
within 2**62 and deviation within 64 bits; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemosieve.llm.common import read_table, scale_floored, tree_sum, valid_vector, vector_rows, written

SCALE, OFFSET, COMPONENTS, TINY = 64, 1_000_000, 16, 1e-13
LARGEST = float(1 << 62)


@dataclass
class Whitening:
    """n and sums of the fit list; projection: a column for each component, scaled to unit variance; explained: its share of the variance."""

    n: int
    sums: list[int]
    projection: np.ndarray
    explained: np.ndarray
    variance: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return centred(x, whole, part)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """sum of (n * x - S)**2, exact; Python integers where 64 bits could overflow."""
        most = self.n * (int(np.abs(x).max()) + 1) + max(map(abs, self.sums)) if len(x) else 0
        if most < 1 << 62:
            off = x * np.int64(self.n) - np.array(self.sums, np.int64)
            if x.shape[1] * int(np.abs(off).max(initial=0)) ** 2 < 1 << 63:
                return (off * off).sum(1)
        off = x.astype(object) * self.n - np.array(self.sums, object)
        return np.array([min(v, (1 << 63) - 1) for v in (off * off).sum(1)], np.int64)


def centred(x: np.ndarray, whole: np.ndarray, part: np.ndarray) -> np.ndarray:
    if np.abs(x).max(initial=0) < 1 << 61:
        return (x - whole).astype(np.float64) - part
    return (x.astype(object) - whole).astype(np.float64) - part


def summed(batch: pa.RecordBatch) -> np.ndarray:
    x = vector_rows(batch.column(0))
    if int(np.abs(x).max(initial=0)) * len(x) < 1 << 62:
        return x.sum(0).astype(object)
    return x.astype(object).sum(0)


def outer(whole: np.ndarray, part: np.ndarray, x: np.ndarray) -> np.ndarray:
    y = centred(x, whole, part)
    return y.T @ y


def fit(vectors: DataFrame, dimension: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct vectors (_x: array<long>, all of this dimension)."""
    distinct = written(vectors.select("_x").distinct(), "fit-list")
    n = distinct.count()
    sums = [int(v) for v in tree_sum(distinct, summed, np.zeros(dimension, object))]
    whole, part = np.array([s // n for s in sums], np.int64), np.array([(s % n) / n for s in sums])
    covariance = tree_sum(distinct, lambda b: outer(whole, part, vector_rows(b.column(0))), np.zeros((dimension, dimension))) / n
    values, directions = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    e, v = np.maximum(values[order], 0), directions[:, order]
    v = v * np.where(v[np.abs(v).argmax(0), np.arange(v.shape[1])] < 0, -1, 1)  # either sign is right; the largest entry is positive
    held = e > TINY * max(values.max(), 0)
    projection = np.where(held, v / np.sqrt(np.where(held, e, 1)), 0)
    trace = np.trace(covariance)
    model = Whitening(n, sums, projection, e / trace if trace > 0 else np.zeros(len(e)), e)
    square = tree_sum(distinct, lambda b: (w := centred(vector_rows(b.column(0)), whole, part) @ projection).T @ w, np.zeros((len(e), len(e)))) / n
    error = np.abs(square - np.eye(len(e)))[np.ix_(held, held)]
    model.identity_error = float(error.max(initial=0))
    return model


def projected(vectors: DataFrame, model: Whitening, keep: list[str]) -> DataFrame:
    """keep, deviation and whitened (array<double>) of vectors (_x and others)."""
    sent = vectors.sparkSession.sparkContext.broadcast(model)
    own = vectors.select("_x", F.struct(*keep).alias("_own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = vector_rows(batch.column(0))
                w = sent.value.centred(x) @ sent.value.projection
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(sent.value.deviation(x)), lists], ["_own", "deviation", "whitened"])

    out = own.mapInArrow(run, own.select("_own", F.lit(0).cast("long").alias("deviation"), F.array(F.lit(0.0)).alias("whitened")).schema)
    return out.select(*(F.col("_own").getField(k).alias(k) for k in keep), "deviation", "whitened")


def whitened(rows: DataFrame, column: str = "embedding", keep: tuple[str, ...] = ("vec_id",), components: int = COMPONENTS) -> DataFrame:
    """keep, n, deviation, whitened (an array), explained (an array) and identity_error, for each row whose vector takes part."""
    x = scale_floored(F.col(f"`{column}`"), SCALE, LARGEST)
    vectors = rows.where(valid_vector(F.col(f"`{column}`"))).select(*(F.col(f"`{k}`") for k in keep), F.transform(x, lambda v: v.cast("long") + OFFSET).alias("_x"))
    lengths = sorted(r[0] for r in vectors.select(F.size("_x")).distinct().collect())  # in an embedding table, one
    out = []
    for d in lengths:
        own = vectors.where(F.size("_x") == d)
        model = fit(own, d, components)
        out.append(projected(own, model, list(keep)).withColumns({"n": F.lit(model.n).cast("long"), "explained": F.array(*map(F.lit, model.explained.tolist())), "identity_error": F.lit(model.identity_error)}))
    if not out:
        return vectors.select(*keep, F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"), F.array(F.lit(0.0)).alias("whitened"), F.array(F.lit(0.0)).alias("explained"), F.lit(0.0).alias("identity_error")).limit(0)
    first, *others = (x.select(*keep, "n", "deviation", "whitened", "explained", "identity_error") for x in out)
    for x in others:
        first = first.unionByName(x)
    return first


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitened(read_table(spark, sf_dir, "embeddings"))
    each = rows.select("vec_id", "n", "deviation", F.posexplode("whitened").alias("p", "whitened"), "explained", "identity_error")
    return each.select("vec_id", (F.col("p") + 1).cast("int").alias("component"), "n", "deviation", "whitened", F.col("explained")[F.col("p")].alias("explained"), "identity_error")
