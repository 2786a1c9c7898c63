"""From raw documents to packed training sequences: five stages, each an operator of mnemosieve.llm.

STAGES: (name, function) in order; a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents.

Defined results of every stage follow the operator's own docstring: null texts count as empty, an empty table gives an empty table, repeated rows
and ties are settled by doc_id, further columns (also those named like a column of an operator) pass through the first four stages unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemosieve.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from mnemosieve.llm.common import read_table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores under the threshold."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: words of five, similarity of 0.8."""
    return ngram_join.representatives(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mixing.mixture(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its place in a sequence."""
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Training a network, the shingle join and bin completion aren't SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir).select(*docs.columns), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
