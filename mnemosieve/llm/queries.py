"""The queries of these operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Query and the module whose function opN it is; a module may hold ORACLE_SQL.
QUERIES = {
    "op1_best_fit_packing": "packing",
    "op2_exact_topk_search": "topk_search",
    "op3_url_filter": "url_filter",
    "op4_pii": "pii",
    "op5_quality_classifier": "quality",
    "op6_exact_dedup": "exact_dedup",
    "op7_toxicity": "toxicity",
    "op8_source_mixing": "mixing",
    "op9_ngram_jaccard_join": "ngram_join",
    "op10_html_extraction": "html_extract",
    "op11_byte_bpe": "byte_bpe",
    "op12_embedding_whitening": "whitening",
    "op13_vector_codes": "vector_codes",
}


def _module(name: str):
    return importlib.import_module(f"mnemosieve.llm.{name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query: getattr(_module(name), query.split("_")[0]) for query, name in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {query: sql for query, name in QUERIES.items() if (sql := getattr(_module(name), "ORACLE_SQL", None))}
