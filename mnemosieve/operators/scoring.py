"""Lexical order and hybrid ranking for a batch of queries.

Statistics are those of the whole corpus; filters come after ranking and never change a score. Sums of floats run in the order of a query's tokens.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType

from mnemosieve.functions.text import distinct_tokens, tokens
from mnemosieve.functions.vectors import boost, dot_f32
from mnemosieve.operators.index import SCORING
from mnemosieve.sources.tables import written

VARIANTS = ("field_cov", "cov_n", "idf_cov")
#: Rows and bytes of query tokens, or of query vectors, up to which they are broadcast; a larger batch is joined by a shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


@dataclass(frozen=True)
class Ranking:
    """Weight of the boost, size of the pool (0: all candidates) and kind of coverage."""

    weight: float = 0.2
    top_k: int = 50
    coverage: str = "field_cov"


def weight(column: str, kind: DataType) -> Column:
    """Bytes of a column's value, about."""
    c = F.col(f"`{column}`")
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, (StringType, BinaryType)):
        return F.coalesce(F.aggregate(c, F.lit(0), lambda s, x: s + F.coalesce(F.octet_length(x), F.lit(0)) + 8), F.lit(0))
    if isinstance(kind, (ArrayType, MapType)):
        return F.greatest(F.size(c), F.lit(0)) * 8
    return F.lit(8)


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df, written once, to be broadcast if it has at most `rows` rows and weighs at most `size` bytes."""
    df = written(df, "small")
    return F.broadcast(df) if fits(df, rows, size) else df


def fits(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether df (a written table) may be broadcast."""
    each = sum((weight(f.name, f.dataType) for f in df.schema.fields), F.lit(16)).cast("long")
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(each), F.lit(0))).first()
    return n <= rows and total <= size


def query_tokens(queries: DataFrame) -> DataFrame:
    """query_id, pos, token, kind, n_query_tokens of queries (query_id, query): each token once, in order."""
    found = queries.select("query_id", distinct_tokens(F.col("query")).alias("t"))
    return found.select("query_id", F.size("t").alias("n_query_tokens"), F.posexplode("t").alias("pos", "tok")).select("query_id", "pos", "tok.token", "tok.kind", "n_query_tokens")


def with_idf(wanted: DataFrame, term_rows: DataFrame, n_docs: int) -> DataFrame:
    """Query tokens with df (0 where unknown) and idf."""
    df = F.coalesce(F.col("df"), F.lit(0)).cast("double")
    return wanted.join(term_rows, ["token", "kind"], "left").withColumn("df", F.coalesce("df", F.lit(0))).withColumn("idf", F.log(F.lit(1.0) + (F.lit(float(n_docs)) - df + 0.5) / (df + 0.5)))


def bm25(idf: Column, tf: Column, lnorm: Column, k1: float) -> Column:
    return idf * F.lit(k1 + 1.0) * tf / (tf + F.lit(k1) * lnorm)


def field_weight(tf_title: Column, tf_content: Column, in_label: Column) -> Column:
    """3 in the title, 2 in type or project, 1 in the content alone."""
    return F.when(tf_title > 0, 3.0).when(in_label, 2.0).when(tf_content > 0, 1.0).otherwise(0.0)


def matches(docs: DataFrame, posted: DataFrame, wanted: DataFrame, mean: float, params: dict[str, float]) -> DataFrame:
    """A row for each query token in a document: query_id, pos, doc_id, idf, raw (BM25) and w (field weight). wanted: tokens with idf."""
    k1, b, title_weight = params["scoring_k1"], params["scoring_b"], params["scoring_title_weight"]
    labels = lambda c: F.transform(tokens(F.col(c)), lambda t: F.concat(t["kind"], t["token"]))
    fields = docs.select("doc_id", "n_tokens", F.array_distinct(F.concat(labels("type"), labels("project"))).alias("labels"))
    found = posted.join(small(wanted), ["token", "kind"]).join(fields, "doc_id")
    lnorm = F.lit(1.0 - b) + F.lit(b) * F.col("n_tokens") / F.lit(mean)
    tf = F.lit(title_weight) * F.col("tf_title") + F.col("tf_content")
    in_label = F.array_contains("labels", F.concat("kind", "token"))
    return found.select("query_id", "pos", "token", "kind", "doc_id", "idf", "n_query_tokens", bm25(F.col("idf"), tf, lnorm, k1).alias("raw"), field_weight(F.col("tf_title"), F.col("tf_content"), in_label).alias("w"))


def lexical_scores(found: DataFrame, wanted: DataFrame, coverage: str = "field_cov", params: dict[str, float] = SCORING) -> DataFrame:
    """query_id, doc_id, coverage, ordering, raw, matched of each candidate. A query has at most as many rows for a document as tokens."""
    if coverage not in VARIANTS:
        raise ValueError(f"coverage is one of {', '.join(VARIANTS)}")
    total = F.aggregate(F.array_sort(F.collect_list(F.struct("pos", "idf"))), F.lit(0.0), lambda s, e: s + e["idf"])
    per_query = lambda: wanted.groupBy("query_id").agg(total.alias("t")).select("query_id", F.when(F.col("t") != 0, F.col("t")).otherwise(1.0).alias("total_idf"))
    # field weights and counts are whole numbers, which any order sums alike; sums of fractions run in the order of the tokens
    fractions = ["raw", "idf"] if coverage == "idf_cov" else ["raw"]
    fold = lambda name: F.aggregate("m", F.lit(0.0), lambda s, e: s + e[name])
    summed = found.groupBy("query_id", "doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", *fractions))).alias("m"), F.sum("w").alias("wmass"), F.count(F.lit(1)).cast("int").alias("matched"), F.max("n_query_tokens").alias("nq"))
    summed = summed.withColumns({"raw": fold("raw")} | ({"mass": fold("idf")} if coverage == "idf_cov" else {})).drop("m")
    if coverage == "field_cov":
        scored = summed.withColumn("coverage", F.col("wmass") / (F.lit(3.0) * F.col("nq")))
    elif coverage == "cov_n":
        scored = summed.withColumn("coverage", F.col("matched") / F.col("nq").cast("double"))
    else:
        scored = summed.join(small(per_query()), "query_id").withColumn("coverage", F.col("mass") / F.col("total_idf"))
    evidence = F.lit(params["scoring_evidence_weight"]) * (F.col("raw") / (F.col("raw") + 1.0))
    ordering = F.col("coverage") if coverage == "idf_cov" else F.col("coverage") + evidence
    return scored.select("query_id", "doc_id", "coverage", ordering.alias("ordering"), "raw", "matched")


def pool(scores: DataFrame, top_k: int, order: Column | None = None) -> DataFrame:
    """The first top_k candidates of each query (all, for 0), with lex_rank. Each partition keeps its own first ones before rows meet."""
    key = F.desc("ordering") if order is None else order
    ranked = scores.withColumn("lex_rank", F.row_number().over(Window.partitionBy("query_id").orderBy(key, "doc_id")))
    return ranked.where(F.col("lex_rank") <= top_k) if top_k > 0 else ranked


def cosines(docs: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id, doc_id, cosine for every document and query; 0 where the document has no vector. queries: query_id, vec."""
    corpus = docs.select("doc_id").join(vectors.select("doc_id", "vec"), "doc_id", "left")
    asked = small(queries.select("query_id", F.col("vec").alias("q")))
    return corpus.join(asked).select("query_id", "doc_id", F.when(F.col("vec").isNull() | F.col("q").isNull(), F.lit(0.0).cast("float")).otherwise(dot_f32(F.col("q"), F.col("vec"))).alias("cosine"))


def boosted(cosine: DataFrame, members: DataFrame, weight: float) -> DataFrame:
    """query_id, doc_id, cosine, coverage, boosted: pool members gain, the others keep their cosine."""
    return cosine.join(members.select("query_id", "doc_id", "coverage"), ["query_id", "doc_id"], "left").withColumn("boosted", F.when(F.col("coverage").isNull(), F.col("cosine")).otherwise(boost(F.col("cosine"), F.col("coverage"), weight)))


def ranked(scores: DataFrame, order: Column | None = None) -> DataFrame:
    """scores with rank, over the whole corpus, per query."""
    key = F.desc("boosted") if order is None else order
    return scores.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(key, "doc_id")))


def shared_rare_terms(found: DataFrame, shown: DataFrame, most: int) -> DataFrame:
    """query_id, doc_id, terms: up to `most` query tokens in a shown document, rarest first, then by code point. shown: query_id, doc_id."""
    rows = found.join(small(shown.select("query_id", "doc_id")), ["query_id", "doc_id"], "left_semi").groupBy("query_id", "doc_id")
    first = F.slice(F.transform(F.array_sort(F.collect_list(F.struct((-F.round("idf", 6)).alias("i"), "token"))), lambda x: x["token"]), 1, max(1, most))
    return rows.agg(first.alias("terms")) if most > 0 else rows.agg(F.array().cast("array<string>").alias("terms"))
