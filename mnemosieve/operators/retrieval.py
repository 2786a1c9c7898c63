"""Retrieval with filters, limit and exact flags, and similarity candidates with evidence.

A ranking is never filtered before it is ranked. Flags and counts are aggregates over the whole ranking; a shown record's global rank is the number
of records before it, counted by comparing with the few shown ones, so no task ever sorts a corpus, and no table of all scores is made (see passes).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemosieve.functions.text import content_sha, excerpt
from mnemosieve.functions.requests import limit_of
from mnemosieve.operators.passes import Passes
from mnemosieve.operators.scoring import boosted, cosines, ranked, small
from mnemosieve.sources.tables import written

SHARED_TERMS = 5


@dataclass(frozen=True)
class Request:
    """Filters of one retrieval; None and '' mean none. A project is required unless all_projects."""

    limit: float | None = None
    project: str | None = None
    all_projects: bool = False
    type: str | None = None
    scope: str | None = None

    def __post_init__(self) -> None:
        if not self.project and not self.all_projects:
            raise ValueError("a project is needed, or all_projects")

    def passes(self) -> Column:
        out = F.lit(True)
        if not self.all_projects:
            out = out & (F.col("project") == self.project)
        for name in ("type", "scope"):
            if value := getattr(self, name):
                out = out & (F.col(name) == value)
        return out


def displayed(scores: DataFrame, docs: DataFrame) -> DataFrame:
    """scores with what is shown of a document; ids that the documents lack drop out."""
    return scores.join(docs.select("doc_id", "title", "content", "type", "project", "scope"), "doc_id")


def hits(scores: DataFrame, docs: DataFrame, request: Request, order: Column | None = None) -> DataFrame:
    """The first `limit` passing documents of each query: query_id, place, doc_id, title, type, project, scope, score, excerpt."""
    key = F.desc("boosted") if order is None else order
    first = displayed(scores, docs).where(request.passes()).withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(key, "doc_id")))
    return first.where(F.col("place") <= limit_of(request.limit)).select("query_id", "place", "doc_id", "title", "type", "project", "scope", F.col("boosted").alias("score"), excerpt(F.col("content")).alias("excerpt"))


def recalled(docs: DataFrame, vectors: DataFrame, queries: DataFrame, members: DataFrame, request: Request, weight: float, digits: int | None = None) -> DataFrame:
    """hits() of all documents, scored in tasks. queries: query_id, vec; members: query_id, doc_id, coverage of the pools. digits: places to which scores are
    rounded before they are compared."""
    passes = Passes(docs, vectors, queries.select("query_id", "vec"), members, weight, digits, request.passes(), once=True)
    first = passes.leading(limit_of(request.limit)).select("query_id", "doc_id", F.col("score").alias("boosted"))
    return hits(small(first), docs, request).withColumn("score", F.col("score").cast("float" if digits is None else "double"))


def recall_summary(docs: DataFrame, queries: DataFrame, request: Request, lexical: DataFrame, top_k: int) -> DataFrame:
    """summary() from the documents alone: how many pass doesn't depend on the query. lexical: query_id, doc_id of all candidates."""
    passing, rest = docs.agg(F.count_if(request.passes()), F.count_if(~request.passes())).first()
    of_pool = lexical.groupBy("query_id").agg(F.count(F.lit(1)).alias("candidates"))
    n, limit = F.coalesce("candidates", F.lit(0)), limit_of(request.limit)
    return queries.select("query_id").join(of_pool, "query_id", "left").select("query_id", F.lit(limit).alias("limit"), F.lit(passing > limit).alias("truncated"), F.lit(rest).cast("long").alias("filtered_out"), (F.least(n, F.lit(top_k)) if top_k > 0 else n).cast("long").alias("pool_size"), n.cast("long").alias("candidates"))


def summary(scores: DataFrame, docs: DataFrame, request: Request, candidates: DataFrame, top_k: int) -> DataFrame:
    """One row a query: limit, truncated, filtered_out, pool_size, candidates. candidates: query_id, doc_id."""
    counted = displayed(scores, docs).groupBy("query_id").agg(F.count_if(request.passes()).alias("passing"), F.count_if(~request.passes()).alias("filtered_out"))
    of_pool = candidates.groupBy("query_id").agg(F.count(F.lit(1)).alias("candidates"))
    n = F.coalesce("candidates", F.lit(0))
    limit = limit_of(request.limit)
    return counted.join(of_pool, "query_id", "left").select("query_id", F.lit(limit).alias("limit"), (F.col("passing") > limit).alias("truncated"), "filtered_out", (F.least(n, F.lit(top_k)) if top_k > 0 else n).cast("long").alias("pool_size"), n.cast("long").alias("candidates"))


def available_types(docs: DataFrame) -> DataFrame:
    """Types that occur, in order; of all projects."""
    return docs.select("type").where("type <> ''").distinct().orderBy("type")


def candidates(passes: Passes, limit: int) -> tuple[DataFrame, DataFrame]:
    """The first `limit` documents of each query's project with their ranks in the whole corpus: query_id, doc_id, place, semantic_rank; and query_id,
    filtered_out: the documents of other projects before the (limit + 1)-th passing one, or all of them if there is none. Two passes: one finds the
    documents, one counts what stands before them."""
    first = written(passes.leading(limit + 1), "first")
    told = written(first.join(passes.before(first), ["query_id", "doc_id"]), "candidates")
    cut = told.where(F.col("place") == limit + 1).select("query_id", "barred")
    each = passes.rows.groupBy("project").agg(F.count(F.lit(1)).alias("own"))
    total = passes.rows.agg(F.count(F.lit(1)).alias("total"))
    others = F.when(F.col("project") == "", 0).otherwise(F.col("total") - F.coalesce("own", F.lit(0)))
    filtered = passes.asked.select("query_id", "project").join(total).join(each, "project", "left").join(cut, "query_id", "left").select("query_id", F.coalesce("barred", others).cast("long").alias("filtered_out"))
    return told.where(F.col("place") <= limit).select("query_id", "doc_id", "place", (F.col("before") + 1).alias("semantic_rank")), filtered


def pool_ids(passes: Passes, top_k: int) -> DataFrame:
    """query_id, doc_id, place: the first documents of the whole ranking, as many as a query's pool (of top_k at most; 0: all candidates) has members. A pool
    without a bound takes the table of all scores."""
    sizes = passes.pools.groupBy("query_id").agg(F.count(F.lit(1)).alias("k"))
    if top_k:
        first = passes.leading(top_k, any_project=True)
    else:
        first = ranked(boosted(cosines(passes.docs, passes.vectors, passes.asked), passes.pools, passes.weight)).withColumnRenamed("rank", "place")
    return first.join(sizes, "query_id").where("place <= k").select("query_id", "doc_id", "place")


def evidence(shown: DataFrame, docs: DataFrame, requests: DataFrame, shared: DataFrame, extras: DataFrame) -> DataFrame:
    """What can be checked about each shown candidate. requests: query_id, title, content, type, topic_key, session_id; extras: id, topic_key, session_id."""
    asked = requests.select("query_id", *[F.col(c).alias(f"q_{c}") for c in ("title", "type", "topic_key", "session_id")], content_sha(F.col("title"), F.col("content")).alias("q_sha"))
    n = docs.agg(F.count(F.lit(1)).alias("corpus_size"))
    rows = (
        shown.join(docs.select("doc_id", "title", "type", "updated_at", "content_sha"), "doc_id").join(small(asked), "query_id")
        .join(shared, ["query_id", "doc_id"], "left").join(extras.withColumnRenamed("id", "doc_id"), "doc_id", "left").join(n)
    )
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    terms = F.coalesce("terms", F.array().cast("array<string>"))
    return rows.select(
        "query_id", "doc_id", "title", "type", "updated_at", F.when((F.col("q_topic_key") != "") & (text("topic_key") == F.col("q_topic_key")), text("topic_key")).otherwise("").alias("same_topic_key"),
        ((F.col("q_session_id") != "") & (text("session_id") == F.col("q_session_id"))).alias("same_session"), ((F.col("type") == F.col("q_type")) & (F.col("title") == F.col("q_title"))).alias("same_type_and_title"),
        (F.col("content_sha") == F.col("q_sha")).alias("identical_content"), F.struct(F.size(terms).alias("count"), terms.alias("terms")).alias("shared_rare_terms"), "place", "semantic_rank", "corpus_size",
    )


def will_update(shown: DataFrame, written: DataFrame) -> DataFrame:
    """shown with will_update: whether the write that followed touched the candidate. written: query_id, written_id."""
    return shown.join(written, "query_id", "left").withColumn("will_update", F.coalesce(F.col("doc_id") == F.col("written_id"), F.lit(False))).drop("written_id")


def index_lag(docs: DataFrame, snapshot: DataFrame) -> DataFrame:
    """One row: records of the source, documents of the index, and the difference (which may be negative)."""
    return snapshot.agg(F.count(F.lit(1)).alias("source_docs")).join(docs.agg(F.count(F.lit(1)).alias("index_docs"))).withColumn("lag_docs", F.col("source_docs") - F.col("index_docs"))
