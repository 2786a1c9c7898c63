"""Identity of a set of files: fingerprints, digests of declarations, and what differs from what was declared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemosieve.sources.observations import tree_digest


def dir_fingerprint(files: DataFrame) -> DataFrame:
    """group, fingerprint: SHA-256 of 'path newline sha newline' over a group's files, in order of UTF-16 units of the path. A manifest is a small table."""
    key = F.hex(F.encode("rel_path", "UTF-16BE"))
    rows = F.array_sort(F.collect_list(F.struct(key.alias("k"), F.concat("rel_path", F.lit("\n"), "sha256", F.lit("\n")).alias("s"))))
    return files.groupBy("group").agg(F.sha2(F.array_join(F.transform(rows, lambda x: x["s"]), ""), 256).alias("fingerprint"))


def identity_digest(declaration: DataFrame) -> DataFrame:
    """One row: the digest of a declaration (rel_path, bytes, sha256)."""
    rows = F.array_sort(F.collect_list(F.concat_ws(" ", "rel_path", F.col("bytes").cast("string"), "sha256")))
    return declaration.agg(F.sha2(F.array_join(rows, "\n"), 256).alias("identity"))


def compared(declared: DataFrame, installed: DataFrame) -> DataFrame:
    """rel_path, state: missing, mismatch, extra or ok."""
    have = installed.select("rel_path", F.col("bytes").alias("b"), F.col("sha256").alias("s"), F.lit(True).alias("there"))
    both = declared.withColumn("wanted", F.lit(True)).join(have, "rel_path", "full")
    state = F.when(F.col("there").isNull(), "missing").when(F.col("wanted").isNull(), "extra").when((F.col("bytes") == F.col("b")) & (F.col("sha256") == F.col("s")), "ok").otherwise("mismatch")
    return both.select("rel_path", state.alias("state"))


def identity_tree(declaration: DataFrame) -> str:
    """The digest of a declaration of any length, as a tree over its files in order of path (rel_path, unique; bytes, sha256)."""
    return tree_digest(declaration, ["rel_path"], F.concat_ws(" ", "rel_path", F.col("bytes").cast("string"), "sha256"))
