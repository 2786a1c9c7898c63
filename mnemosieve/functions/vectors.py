"""Exact 32-bit vector arithmetic and the hash embedder, as column expressions."""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot_f32(a: Column, b: Column) -> Column:
    """Products and sums rounded to 32 bits, strictly from left to right."""
    products = F.zip_with(a.cast("array<float>"), b.cast("array<float>"), lambda x, y: (x * y).cast("float"))
    return F.aggregate(products, F.lit(0.0).cast("float"), lambda s, x: (s + x).cast("float"))


def boost(cosine: Column, coverage: Column, weight: float) -> Column:
    """The 64-bit product, rounded, then added in 32 bits."""
    return (cosine + (F.lit(weight) * coverage).cast("float")).cast("float")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once a row: inside a lambda an expression from outside is computed anew for each element."""
    return F.transform(F.array(value), use)[0]


def l2_normalize(v: Column) -> Column:
    """Sum of squares in 64 bits, at least 1e-12; components in 32 bits."""
    norm = lambda w: F.greatest(F.sqrt(F.aggregate(w, F.lit(0.0), lambda s, x: s + x * x)), F.lit(1e-12))
    return once(v.cast("array<double>"), lambda w: once(norm(w), lambda n: F.transform(w, lambda x: (x / n).cast("float"))))


def hash_embedding(text: Column, dimension: int = 8, normalize: bool = True) -> Column:
    """Component i is (byte i mod 32 of the text's SHA-256 - 127.5) / 128. The text is digested once, not for each component."""
    def components(digest: Column) -> Column:
        byte = lambda i: F.conv(F.substr(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("double")
        return F.transform(F.sequence(F.lit(0), F.lit(dimension - 1)), lambda i: (byte(i) - 127.5) / 128.0)

    raw = once(F.sha2(text, 256), components)
    return l2_normalize(raw) if normalize else raw


def ordered_sum(items: Column) -> Column:
    """Sum of array<struct<pos, x>> in order of pos, whatever order the rows came in."""
    return F.aggregate(F.array_sort(items), F.lit(0.0), lambda s, e: s + e["x"])


def decode_f32(blob: bytes | None) -> list[float] | None:
    """Little-endian 32-bit floats of a blob."""
    return None if blob is None else np.frombuffer(blob, "<f4").tolist()


def encode_f32(vector: list[float] | None) -> bytes | None:
    return None if vector is None else struct.pack(f"<{len(vector)}f", *vector)


def decode_vector(blob: Column) -> Column:
    @F.pandas_udf("array<float>")
    def decode(blobs: pd.Series) -> pd.Series:
        return blobs.map(decode_f32)

    return decode(blob)


def encode_vector(vector: Column) -> Column:
    @F.pandas_udf("binary")
    def encode(vectors: pd.Series) -> pd.Series:
        return vectors.map(lambda v: None if v is None else np.asarray(v, "<f4").tobytes())

    return encode(vector)
